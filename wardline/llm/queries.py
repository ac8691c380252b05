"""The registered queries: each operator over its whole table, with the columns its contract names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.chunks import exact_groups
from wardline.llm.fim import fim_digests
from wardline.llm.packing import pack
from wardline.llm.parity import near_groups
from wardline.llm.quality import fit_quality, quality_score
from wardline.llm.resample import importance
from wardline.llm.secrets import joined, scan_secrets
from wardline.llm.simhash import near_prints
from wardline.llm.spans import without_repeats
from wardline.llm.tables import documents, remainder, table
from wardline.llm.templates import leaks
from wardline.llm.token_files import token_table
from wardline.llm.tokens import vocabulary
from wardline.llm.toxicity import fit_toxicity, toxicity_score
from wardline.llm.url_rules import judge_urls

#: Scores from which a label is predicted.
THRESHOLD = 0.7
#: The id that ends a document.
END = 2


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan_secrets(documents(spark, sf_dir)).select("doc_id", "secrets")

    def of(kind):
        return F.filter("secrets", lambda s: s["kind"] == kind)

    return rows.select(
        "doc_id", *[F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(joined(F.filter("secrets", lambda s: s["kind"] != "novel")), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"), F.size(of("novel")).cast("bigint").alias("n_novel"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def _scored(docs: DataFrame, held_out, score) -> DataFrame:
    rows = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = documents(spark, sf_dir), remainder(F.col("doc_id"), 3) == 1
    model = fit_toxicity(docs.where(~held), table(spark, sf_dir, "labels").where(~held))
    return _scored(docs, held, toxicity_score(F.col("text"), model))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir), size=4, percent=85)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_table(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), end=END).drop("ids")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), END, 1024, with_ids=False).drop("ids")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = documents(spark, sf_dir), remainder(F.col("doc_id"), 4) == 2
    model = fit_quality(docs.where(~held), table(spark, sf_dir, "labels").where(~held))
    return _scored(docs, held, quality_score(F.col("text"), model))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(documents(spark, sf_dir), size=13, with_text=False).drop("kept")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance(documents(spark, sf_dir), table(spark, sf_dir, "benchmark")).drop("n_words")


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_prints(documents(spark, sf_dir), size=4, distance=4)
    return rows.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim_digests(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_url_filter, op3_toxicity, op4_ngram_jaccard, op5_token_files, op6_exact_dedup,
    op7_best_fit_packing, op8_quality, op9_substring_dedup, op10_benchmark_decontamination,
    op11_importance_resampling, op12_simhash, op13_fill_in_middle)}
