"""Session defaults and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wardline")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.debug.maxToStringFields", "50")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master, where driver and executors share one disk, may fall back
    to a temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir", None
    )
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="wardline-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    context.setCheckpointDir(own)
    return context.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder and continue from there.

    The copy outlives any executor, so a lost one never replays the upstream plan.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


#: Rows of a wide table that one task groups; a row of fifty columns takes over a kilobyte in its map.
ROWS_A_TASK = 100_000


def staged(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), rows_a_file: int = 0) -> DataFrame:
    """Write a stage to the shared folder as Parquet and continue from the files, of at most ``rows_a_file`` rows if given.

    Like ``cut_lineage``, but later reads still prune columns and push filters down. The
    files go when the session's process ends.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.partitionBy(*partition_by).option("maxRecordsPerFile", rows_a_file).parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.parquet(path)


@contextmanager
def setting(spark: SparkSession, name: str, value: object) -> Iterator[None]:
    """What runs or starts inside has this setting; the session's own comes back."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def read_in_parts(spark: SparkSession, parts: int):
    """Jobs that run inside read files in at least so many parts, as far as the files can be cut. Files of few distinct values
    are small, and by their size alone a task would get millions of rows."""
    name = "spark.sql.files.minPartitionNum"
    return setting(spark, name, max(parts, int(spark.conf.get(name, None) or spark.sparkContext.defaultParallelism)))


def small_methods(spark: SparkSession):
    """Jobs that run inside make no method of over 8,000 bytes, which the JVM would not compile but interpret: the
    expressions of fifty or a hundred columns are then cut into several."""
    return setting(spark, "spark.sql.codegen.hugeMethodLimit", 8000)


def collect_together(builders: Sequence[Callable[[], DataFrame]], threads: int = 4) -> list:
    """Collect several small reports, a few at a time.

    A report's job rarely fills the cluster alone; independent ones can share it.
    """
    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(lambda build: build().collect(), builders))
