"""Sources, sinks, projections, casts, filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.operators import clean
from wardline.operators.profile import null_profile
from wardline.plans import stages
from wardline.session import work_path
from wardline.sources import files
from wardline.sources.encounters import table
from wardline.sources.layout import (
    CATEGORICAL,
    DRUG_COMBINATIONS,
    KEY,
    LABEL_CODED,
    NULL_TOKENS,
    NUMERIC,
    encounter_schema,
)


def src01_csv_null_tokens(spark, folder):
    raw = stages.raw(spark, folder).select(*encounter_schema().fieldNames())
    path = work_path(spark, "raw-csv")
    files.write_csv(raw, path)
    return files.read_csv(spark, path, encounter_schema())


def _scan(spark, folder):
    """The encounters as a file with hyphenated names in another order and a column of its own, in which every 97th line has
    a field too many and every 89th a word for a number."""
    def build():
        names = encounter_schema().fieldNames()[::-1]
        broken = F.col(KEY) % 97 == 0
        rows = stages.raw(spark, folder).select(
            *[F.col(c).cast("string").alias(c.replace("_", "-") if c in DRUG_COMBINATIONS else c) for c in names], F.lit("x").alias("note"))
        rows = rows.withColumns({"race": F.when(broken, F.lit("one,more")).otherwise(F.col("race")),
                                 "time_in_hospital": F.when(F.col(KEY) % 89 == 0, F.lit("many")).otherwise(F.col("time_in_hospital"))})
        path = work_path(spark, "broken-csv")
        rows.write.option("header", True).option("quote", "").csv(path)
        return files.scan_csv(spark, path, encounter_schema())

    return stages.once(spark, folder, "scan", build)


def src01_scan_by_header_name(spark, folder):
    return _scan(spark, folder).rows


def src01_scan_rejects(spark, folder):
    return _scan(spark, folder).rejected.groupBy("reason").agg(F.count("*").alias("n"))


def src02_stage_csv(spark, folder):
    source = stages.prepared(spark, folder).select(KEY, "readmitted", *NUMERIC)
    path = work_path(spark, "stage-csv")
    files.write_csv(source, path)
    return files.read_typed_csv(spark, path, source.schema)


def src03_first_rows(spark, folder):
    orders = table(spark, folder, "orders")
    return files.first_rows(
        orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"),
        "o_orderkey", 120)


def src04_snapshot(spark, folder):
    path = work_path(spark, "snapshot")
    files.write_snapshot(
        table(spark, folder, "part").select("p_partkey", "p_brand", "p_type", "p_size"),
        path, ["p_type"])
    return files.read_snapshot(spark, path)


def snk01_csv_round_trip(spark, folder):
    source = table(spark, folder, "customer")
    path = work_path(spark, "customer-csv")
    files.write_csv(source, path)
    return files.read_typed_csv(spark, path, source.schema)


def snk02_json_mapping(spark, folder):
    from wardline.operators.encode import label_codes

    codes = label_codes(stages.raw(spark, folder), ["gender", "insulin", "change"])
    path = work_path(spark, "codes-json")
    files.write_json(codes, path)
    return spark.read.schema(codes.schema).json(path)


def snk02_full_mapping(spark, folder):
    """The codes of all coded columns and the target, as JSON and back."""
    from wardline.operators.encode import label_codes

    codes = label_codes(stages.prepared(spark, folder), [*LABEL_CODED, "readmitted"])
    path = work_path(spark, "mapping-json")
    files.write_json(codes, path)
    return spark.read.schema(codes.schema).json(path)


def snk02_feature_kinds(spark, folder):
    """Numerical and categorical model columns, as one JSON object with their numbers, and back."""
    from wardline.operators.profile import model_kinds
    from wardline.plans.model_table import model_columns, split_rows

    rows = split_rows(spark, folder)
    kinds = model_kinds(rows.where("split = 'train'"), model_columns(rows), LABEL_CODED)

    def of(kind):
        return F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.col("column"))))

    lists = kinds.agg(*[of(k).alias(k) for k in ("numerical", "categorical")])  # one entry a column
    made = lists.select("*", *[F.size(k).alias(f"n_{k}") for k in lists.columns])
    path = work_path(spark, "kinds-json")
    files.write_json(made, path)
    back = spark.read.schema(made.schema).json(path)
    return back.select(F.array_join("numerical", ",").alias("numerical"), F.array_join("categorical", ",").alias("categorical"), "n_numerical", "n_categorical")


def cst02_conversion_log(spark, folder):
    """What the preparation casts: numbers to double, codes to text."""
    from wardline.plans.prepare import impute_and_type

    raw = stages.raw(spark, folder)
    return clean.conversion_log(raw, impute_and_type(raw, stages.cleaned(spark, folder)[1])[0])


def snk06_report_tables(spark, folder):
    raw = clean.null_tokens(stages.raw(spark, folder), NULL_TOKENS)
    report = null_profile(raw)
    path = work_path(spark, "reports")
    files.write_reports({"null_profile": report}, path)
    return files.read_typed_csv(spark, f"{path}/null_profile", report.schema)


def prj01_drop_listed(spark, folder):
    return clean.drop_if_present(
        table(spark, folder, "part"), ["p_name", "p_retailprice", "no_such_column"])


def prj02_by_kind(spark, folder):
    supplier = table(spark, folder, "supplier")
    return supplier.select(*clean.columns_of_kind(supplier, True))


def prj04_rename(spark, folder):
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("nation_id"), F.col("n_name").alias("nation_name"))


def cst01_numeric_coercion(spark, folder):
    raw = stages.raw(spark, folder).select(KEY, "diag_1", "diag_2", "weight")
    return clean.to_number(raw, ["diag_1", "diag_2", "weight"])


def cst02_to_category(spark, folder):
    coded = [c for c in CATEGORICAL if c.endswith("_id")]
    return clean.to_category(stages.raw(spark, folder).select(KEY, *coded), coded)


def cst03_flag(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") > 25).cast("int").alias("large"))


def flt01_class_value(spark, folder):
    raw = stages.raw(spark, folder)
    return raw.where(F.col("readmitted") != "NO").select(KEY, "readmitted", "time_in_hospital")


def flt02_in_list(spark, folder):
    return table(spark, folder, "orders").where(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    ).select("o_orderkey", "o_orderpriority")


def flt03_known_target(spark, folder):
    raw = stages.raw(spark, folder)
    label = F.when(F.col("readmitted") == "<30", 1).when(F.col("readmitted") == ">30", 0)
    return raw.select(KEY, label.alias("label")).dropna(subset=["label"])


def flt04_known_values(spark, folder):
    raw = clean.null_tokens(stages.raw(spark, folder), NULL_TOKENS)
    known = clean.to_number(raw.select("diag_2"), ["diag_2"]).where("diag_2 is not null")
    return known.agg(F.count("*").alias("n"), F.avg("diag_2").alias("mean")).select(
        "n", F.round("mean", 6).alias("mean"))


def flt07_outside_fences(spark, folder):
    prices = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    fit = clean.fit_outliers(prices, ["l_extendedprice"], multiplier=0.5)["l_extendedprice"]
    price = F.col("l_extendedprice")
    return prices.where((price < fit["lower_fence"]) | (price > fit["upper_fence"]))


QUERIES = {f.__name__: f for f in (
    src01_csv_null_tokens, src01_scan_by_header_name, src01_scan_rejects, src02_stage_csv, src03_first_rows, src04_snapshot,
    snk01_csv_round_trip, snk02_json_mapping, snk02_full_mapping, snk02_feature_kinds, cst02_conversion_log, snk06_report_tables,
    prj01_drop_listed, prj02_by_kind, prj04_rename, cst01_numeric_coercion,
    cst02_to_category, cst03_flag, flt01_class_value, flt02_in_list, flt03_known_target,
    flt04_known_values, flt07_outside_fences,
)}
