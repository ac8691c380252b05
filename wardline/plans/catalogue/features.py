"""Engineered columns, one query per group, and the encoded model inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.functions.codes import mapped
from wardline.operators import clean, encode, split
from wardline.operators.features import ENGINEERED, glucose_category
from wardline.operators.score import AGE_CODE, AGE_MIDDLE, GENDER_CODE, INSULIN_CODE
from wardline.plans import stages
from wardline.plans.catalogue.cleaning import rounded
from wardline.plans.model_table import SCALED, model_columns, scaled_split, split_rows
from wardline.session import staged, work_path
from wardline.sources import files
from wardline.sources.encounters import table
from wardline.sources.layout import KEY, LABEL_CODED

GROUPS = {
    "fe01_diagnosis_counts": ENGINEERED[0:4],
    "fe05_chronic_diseases": ENGINEERED[4:10],
    "fe11_medications": ENGINEERED[10:15],
    "fe16_procedures": ENGINEERED[15:19],
    "fe20_hospital_stay": ENGINEERED[19:24],
    "fe25_admissions": ENGINEERED[24:29],
    "fe30_age": ENGINEERED[29:35],
    "fe36_labs": ENGINEERED[35:39],
    "fe40_discharge": ENGINEERED[39:43],
    "fe44_interactions": ENGINEERED[43:48],
}


def _group(columns):
    return lambda spark, folder: rounded(
        stages.engineered(spark, folder).select(KEY, *columns))


def fe50_glucose_category(spark, folder):
    return stages.raw(spark, folder).select(
        KEY, glucose_category(F.col("num_lab_procedures") + 60).alias("glucose_category"))


def enc01_binary_codes(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_linestatus")
    return encode.label_encode(lines, ["l_linestatus"])


def enc02_one_hot_wide(spark, folder):
    raw = stages.prepared(spark, folder).select(KEY, "insulin", "payer_code")
    one = encode.one_hot_wide(raw, "insulin", ["Down", "No", "Steady", "Up"])
    return encode.one_hot_wide(one, "payer_code", ["BC", "HM", "MC", "MD", "SP"])


def enc02_one_hot_vectors(spark, folder):
    """Sparse vectors over brands, checked through the number of ones per position."""
    parts = table(spark, folder, "part").select("p_partkey", "p_brand")
    vectors = encode.one_hot_vectors(
        parts, ["p_brand"], encode.label_codes(parts, ["p_brand"]))
    from pyspark.ml.functions import vector_to_array

    return (
        vectors.select(F.posexplode(vector_to_array("p_brand_vec")).alias("code", "on"))
        .where("on > 0").groupBy("code").agg(F.count("*").alias("n"))
    )


def _texts(spark, folder):
    raw = stages.prepared(spark, folder)
    return raw.select(*[c for c, t in raw.dtypes if t == "string" and c != "readmitted"])


def enc02_encoded_columns(spark, folder):
    """Every text column under its learned encoding: rows with each code, or with a one at each place."""
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import Summarizer

    raw = _texts(spark, folder)
    fitted = encode.fit_encoding(raw)
    out = encode.encode(raw, fitted)
    parts = []
    if hot := fitted.of("one_hot_encoding"):
        ones = out.agg(*[Summarizer.numNonZeros(F.col(f"{c}_vec")).alias(c) for c in hot])
        parts = [ones.select(F.lit(c).alias("column"), F.posexplode(vector_to_array(c)).alias("code", "n")) for c in hot]
    for c in fitted.of("label_encoding"):
        parts.append(out.groupBy(F.col(c).alias("code")).agg(F.count("*").cast("double").alias("n"))
                     .select(F.lit(c).alias("column"), "code", "n"))
    found = parts[0]
    for extra in parts[1:]:
        found = found.unionByName(extra)
    return found.withColumn("n", F.col("n").cast("bigint"))


def enc07_fitted_map(spark, folder):
    return encode.fitted_map(encode.fit_encoding(_texts(spark, folder)))


def enc03_encoding_route(spark, folder):
    raw = stages.prepared(spark, folder)
    columns = [c for c, t in raw.dtypes if t == "string" and c != "readmitted"]
    return encode.encoding_route(raw, columns)


def enc04_label_encoded(spark, folder):
    return encode.label_encode(
        stages.prepared(spark, folder).select(KEY, *LABEL_CODED), LABEL_CODED)


def enc05_class_code(spark, folder):
    return stages.class_code(stages.prepared(spark, folder)).select(
        KEY, F.col("target_code").alias("label"))


def enc06_binary_target(spark, folder):
    return stages.labelled(spark, folder).select(KEY, "label")


def enc07_encoding_map(spark, folder):
    raw = stages.prepared(spark, folder)
    codes = encode.label_codes(raw, [*LABEL_CODED, "readmitted"])
    return codes.withColumn("method", F.lit("label_encoding"))


def enc08_fixed_codes(spark, folder):
    raw = stages.raw(spark, folder)
    band = F.translate("age", "[)", "")
    return raw.select(
        KEY,
        mapped(band, AGE_CODE, 7).alias("age_code"),
        mapped(F.col("gender"), GENDER_CODE, 0).alias("gender_code"),
        mapped(F.col("insulin"), INSULIN_CODE, 1).alias("insulin_code"),
        mapped(band, AGE_MIDDLE, 75).alias("age_middle"),
    )


def encoded_model_table(spark, folder):
    rows = split_rows(spark, folder)
    return rounded(rows.select(KEY, *model_columns(rows), "label", "split"))


def prj03_feature_projection(spark, folder):
    rows = split_rows(spark, folder)
    return rounded(rows.where(F.col("split") == "test").select(KEY, *model_columns(rows)))


def ml01_split(spark, folder):
    return split_rows(spark, folder).select(KEY, "label", "split")


def ml01_split_orders(spark, folder):
    """The split on another table and class column; three classes, hot ones included."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return split.stratified_split(orders, "o_orderkey", "o_orderstatus")


def ml02_leakage_checks(spark, folder):
    rows = split_rows(spark, folder)
    return split.leakage_checks(rows, KEY, "label", scaled_split(spark, folder)[1], SCALED)


def ml18_positive_rate(spark, folder):
    rows = split_rows(spark, folder).where(F.col("split") == "test")
    return rows.agg(
        F.count("*").alias("n"), F.sum("label").alias("n_positive"),
        F.round(F.avg("label"), 6).alias("positive_rate"))


def ml18_toxic_rate(spark, folder):
    return table(spark, folder, "labels").agg(
        F.count("*").alias("n"), F.round(F.avg("toxic"), 6).alias("positive_rate"))


def agg08_split_summary(spark, folder):
    return split.split_summary(split_rows(spark, folder), "label")


def agg19_rate_spread(spark, folder):
    return rounded(split.rate_spread(split_rows(spark, folder), "label"))


def scl01_scaler(spark, folder):
    from wardline.operators.reshape import aggregates, row_per_column

    train = split_rows(spark, folder).where(F.col("split") == "train")
    wide = train.agg(*aggregates(SCALED, mean=F.avg, std=F.stddev_pop))
    return rounded(row_per_column(wide, SCALED, {"mean": "double", "std": "double"}, name="feature"))


def scl02_scaled_rows(spark, folder):
    return rounded(scaled_split(spark, folder)[0].select(KEY, "split", *SCALED))


def scl03_scaling_report(spark, folder):
    train = F.col("split") == "train"
    before = split_rows(spark, folder).where(train)
    after = scaled_split(spark, folder)[0].where(train)
    return rounded(encode.scaling_report(before, after, SCALED), 4)


def snk03_split_snapshots(spark, folder):
    """Every split in its own folder, in two formats; the CSV copy is read back."""
    rows = split_rows(spark, folder).select(KEY, "label", "age", "comorbidity_index", "split")
    path = work_path(spark, "splits")
    files.write_snapshot(rows, f"{path}/parquet", ["split"])
    rows.write.partitionBy("split").option("header", True).csv(f"{path}/csv")
    return spark.read.schema(rows.schema).option("header", True).csv(f"{path}/csv")


def snk03_model_snapshots(spark, folder):
    """All scaled model columns of every split in two formats, both read back."""
    rows = scaled_split(spark, folder)[0].select(KEY, *model_columns(scaled_split(spark, folder)[0]), "label", "split")
    path = work_path(spark, "model-splits")
    kept = staged(rows, "scaled-once")
    files.write_snapshot(kept, f"{path}/parquet", ["split"])
    kept.write.partitionBy("split").option("header", True).csv(f"{path}/csv")
    back = [files.read_snapshot(spark, f"{path}/parquet"), spark.read.schema(kept.schema).option("header", True).csv(f"{path}/csv")]
    both = [df.select(*kept.columns, F.lit(name).alias("format")) for df, name in zip(back, ("parquet", "csv"))]
    return rounded(both[0].unionByName(both[1]))


def _gapped_inputs(spark, folder):
    """Scaled model columns as numbers; a twentieth of each has gaps, at other rows for every column."""
    rows = scaled_split(spark, folder)[0]
    columns = model_columns(rows)
    return rows.select(KEY, "split", *[
        F.when((F.col(KEY) + i) % 20 != 0, F.col(c).cast("double")).alias(c) for i, c in enumerate(columns)]), columns


def cln06_all_model_inputs(spark, folder):
    """Gaps of every model column filled by its median among the training rows."""
    rows, columns = _gapped_inputs(spark, folder)
    medians = clean.fit_input_medians(rows.where(F.col("split") == "train"), columns)
    return rounded(clean.fill(rows, medians))


def cln06_model_input_impute(spark, folder):
    """Gaps of every split filled by the median of the training rows."""
    coded = clean.to_number(stages.raw(spark, folder).select(KEY, "diag_2"), ["diag_2"])
    # Both sides have a row an encounter, however small their files are; neither is broadcast.
    rows = coded.join(split_rows(spark, folder).select(KEY, "split").hint("merge"), KEY)
    medians = clean.fit_medians(rows.where(F.col("split") == "train"), ["diag_2"])
    return clean.fill(rows, medians)


QUERIES = {name: _group(columns) for name, columns in GROUPS.items()}
QUERIES |= {f.__name__: f for f in (
    fe50_glucose_category, enc01_binary_codes, enc02_one_hot_wide, enc02_one_hot_vectors, enc02_encoded_columns, enc07_fitted_map,
    enc03_encoding_route, enc04_label_encoded, enc05_class_code, enc06_binary_target,
    enc07_encoding_map, enc08_fixed_codes, encoded_model_table, prj03_feature_projection,
    ml01_split, ml01_split_orders, ml02_leakage_checks, ml18_positive_rate,
    ml18_toxic_rate, agg08_split_summary, agg19_rate_spread, scl01_scaler,
    scl02_scaled_rows, scl03_scaling_report, snk03_split_snapshots,
    cln06_model_input_impute, cln06_all_model_inputs, snk03_model_snapshots,
)}
