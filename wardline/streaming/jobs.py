"""Streams of arriving encounters and of scored records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wardline.operators.records import assemble
from wardline.session import setting


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files as a stream; the schema is declared."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def with_event_time(stream: DataFrame, column: str, lateness: str) -> DataFrame:
    """Event time with a watermark; a time without zone is read in the session's zone."""
    return stream.withColumn(column, F.col(column).cast("timestamp")).withWatermark(
        column, lateness)


def score_stream(inputs: DataFrame) -> DataFrame:
    """Scored records of arriving inputs: the batch expressions, unchanged."""
    return assemble(inputs)


def without_resent(stream: DataFrame, key: str = "record_id") -> DataFrame:
    """First arrival of each key within the watermark; state older than it is dropped."""
    return stream.dropDuplicatesWithinWatermark([key])


def status_windows(stream: DataFrame, width: str = "1 day") -> DataFrame:
    """Count and mean risk per event-time window and status."""
    return stream.groupBy(F.window("timestamp", width), "status").agg(
        F.count("*").alias("n"), F.avg("risk_score").alias("avg_risk")
    ).select("window.start", "status", "n", "avg_risk")


def state_partitions(spark: SparkSession, rows: int, each: int = 250_000) -> int:
    """Parts of a state that ``rows`` rows go through: one a core, more where one would see over ``each`` of them. Every
    part is read, checkpointed and committed in every trigger, also where nothing came for it."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // each))


def shuffle_partitions(spark: SparkSession, parts: int):
    """Streams that are started inside keep their state in so many parts, for good; the session's setting comes back."""
    return setting(spark, "spark.sql.shuffle.partitions", parts)


def append_to_files(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Exactly-once file sink over what is available now."""
    return (
        stream.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).outputMode("append")
        .trigger(availableNow=True).start()
    )


def revisions_to_files(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Update-mode aggregates as numbered revisions.

    A batch writes its own folder, so a repeated batch replaces its rows.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("revision", F.lit(number)).write.mode("overwrite").parquet(
            f"{path}/batch={number}")

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .outputMode("update").trigger(availableNow=True).start()
    )


def newest_revisions(revisions: DataFrame, *keys: str) -> DataFrame:
    """Latest revision of each key."""
    fields = [c for c in revisions.columns if c not in keys]
    return revisions.groupBy(*keys).agg(
        F.max_by(F.struct(*fields), "revision").alias("_r")).select(*keys, "_r.*").drop(
        "revision", "batch")


def finish(query: StreamingQuery) -> None:
    """Wait for a bounded run to end; a failure is raised here."""
    query.awaitTermination()
