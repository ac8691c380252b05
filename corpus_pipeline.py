"""From documents to packed training sequences: five stages, each over all that the one before kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again
for the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.chunks import exact_groups
from wardline.llm.packing import pack
from wardline.llm.parity import near_groups
from wardline.llm.quality import fit_quality, quality_score
from wardline.llm.queries import END, THRESHOLD
from wardline.llm.tables import fold_ascii, remainder, small, table
from wardline.llm.templates import leaks
from wardline.llm.tokens import vocabulary
from wardline.session import staged


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from the labelled ones.
    Where it learned nothing, for want of labels of both classes, all stay."""
    labels = table(spark, sf_dir, "labels").where(~(remainder(F.col("doc_id"), 4) == 2))
    model = fit_quality(docs, labels)
    if not model.weights.any():
        return docs
    return docs.where(quality_score(F.col("text"), model) >= THRESHOLD).select(docs.columns)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one of the largest id. Rows without an id stay; of rows that repeat id and text
    one stays. Other texts of an id whose one text goes stay."""
    groups = staged(exact_groups(docs).where(~F.col("kept")), "gone")
    same = F.sha2(fold_ascii(F.coalesce("text", F.lit(""))), 256)
    gone = small(groups.where("doc_id != keep_id").select("doc_id", F.col("text_sha256").alias("_same")))  # else texts move
    kept = docs.withColumn("_same", same).join(gone, ["doc_id", "_same"], "left_anti")
    twice = small(groups.where("doc_id = keep_id").select("doc_id").distinct())
    again = kept.join(twice, "doc_id", "left_semi").dropDuplicates(["doc_id", "_same"])
    return kept.join(twice, "doc_id", "left_anti").select(docs.columns).unionByName(again.select(docs.columns))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by the shingle join the one of the smallest id; unlinked ones stay.
    Texts that repeat an id are one document and go together, also where only one of them is linked; rows
    without an id stay, also where they are near copies."""
    gone = near_groups(docs, size=5, percent=80).where("component_id != doc_id").select("doc_id")
    return _without(docs, gone)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. A row goes by its text, so repeated and missing ids make no difference."""
    texts = docs.withColumn("_text", F.sha2(F.coalesce("text", F.lit("")), 256))
    gone = leaks(texts, table(spark, sf_dir, "benchmark"), key="_text").select("_text").distinct()
    return texts.join(small(staged(gone, "leaks")), "_text", "left_anti").select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' token pieces and their places in training sequences."""
    return pack(docs, vocabulary("byte_bpe_50k.json"), END, 1024, with_ids=False, keep_words=False).drop("ids")


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    return docs.join(small(staged(gone.where("doc_id is not null"), "gone")), "doc_id", "left_anti").select(docs.columns)


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", distinct_texts),
    ("ngram_jaccard", one_of_each_group),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: A classifier and a tokenizer are not expressible in SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
