"""Scans with rejects, observed metrics, the stored imputer and the run's reports."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.operators import clean, model
from wardline.plans import prepare, reports, stages
from wardline.plans.catalogue.reports import _run
from wardline.sources import files
from wardline.sources.layout import KEY

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("drug_a_b", T.StringType()), T.StructField("n", T.IntegerType())])


def write(tmp_path, **texts):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, text in texts.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_scan_sorts_out_lines(spark, tmp_path):
    path = write(tmp_path, a='n, DRUG-A-B ,extra,id\n1,x,e,10\n2,"a,b",e,11\n3,x,e\n4,x,e,12,more\nmany,x,e,13\n?,None,e,14\n5,x,e,ten\n',
                 b='n, DRUG-A-B ,extra,id\n7,y,e,20\n')
    scan = files.scan_csv(spark, path, SCHEMA)
    assert sorted(map(tuple, scan.rows.collect())) == [(10, "x", 1), (11, "a,b", 2), (14, None, None), (20, "y", 7)]
    assert sorted((r.reason, r.line) for r in scan.rejected.collect()) == [("fields", "3,x,e"), ("fields", "4,x,e,12,more"), ("id", "ten,x,5"), ("n", "13,x,many")]
    assert scan.rows.count() + scan.rejected.count() == 8 and scan.rows.schema == SCHEMA


@pytest.mark.parametrize("header", ["id,n", "id,n,drug_a_b,ID"])
def test_scan_refuses_headers(spark, tmp_path, header):
    with pytest.raises(ValueError):
        files.scan_csv(spark, write(tmp_path, a=f"{header}\n1,2,3,4\n"), SCHEMA)


def test_scan_of_a_header_only(spark, tmp_path):
    scan = files.scan_csv(spark, write(tmp_path, a="id,n,drug_a_b\n"), SCHEMA)
    assert scan.rows.count() == scan.rejected.count() == 0


def _cells(df):
    return df.agg(F.count("*").alias("rows"), *[F.count(f"`{c}`").alias(f"known_{c}") for c in df.columns]).first().asDict()


def test_observed_metrics_equal_a_scan(spark, folder):
    raw, metrics = stages.raw(spark, folder), {}
    rows, params = prepare.prepare(raw, metrics=metrics)
    known = clean.null_tokens(raw, prepare.NULL_TOKENS)
    for name, df in (("before", known), ("after", rows)):
        assert metrics[name] == _cells(df)
    filled = {r["column"]: r["n_filled"] for r in reports.observed_imputation(spark, metrics, params).collect()}
    assert filled and all(n == known.where(F.col(f"`{c}`").isNull()).count() for c, n in filled.items())


def test_metrics_change_no_row_and_count_copies(spark, folder):
    raw = stages.raw(spark, folder)
    some = raw.limit(50).unionByName(raw.limit(50)).unionByName(raw.limit(7))
    metrics = {}
    rows, params = prepare.prepare(some, metrics=metrics)
    plain = prepare.prepare(some, params)[0]
    assert rows.columns == plain.columns and rows.exceptAll(plain).count() == plain.exceptAll(rows).count() == 0
    assert metrics["before"]["rows"] == 107 and metrics["after"]["rows"] == rows.count()
    assert metrics["before"] == _cells(clean.null_tokens(some, prepare.NULL_TOKENS))
    nothing = {}
    assert prepare.prepare(some.limit(0), params, nothing)[0].count() == 0 and nothing["before"]["rows"] == nothing["after"]["rows"] == 0


def test_imputer_is_stored_with_the_scorer(spark, tmp_path):
    rows = spark.createDataFrame([(k, float(k % 5), float(k % 3), int(k % 4 == 0)) for k in range(80)], "id long, a double, b double, label int")
    fit = model.fit_logistic(rows, ["a", "b"])
    medians = clean.fit_input_medians(rows, ["a", "b"])
    assert medians == {"a": 2.0, "b": 1.0}
    gaps = spark.createDataFrame([(1, None, 1.0), (2, 2.0, None), (3, None, None), (4, 2.0, 1.0)], "id long, a double, b double")
    model.save_scorer(spark, model.Scorer(fit, {"a": (0.0, 1.0)}, ["a", "b"], medians), f"{tmp_path}/s")
    stored = model.load_scorer(spark, f"{tmp_path}/s")
    assert stored.medians == medians
    p = {r.id: r.probability for r in model.probability(stored, gaps).collect()}
    assert p[1] == p[2] == p[3] == p[4] is not None
    without = {r.id: r.probability for r in model.probability(stored._replace(medians={}), gaps).collect()}
    assert without[1] is without[2] is without[3] is None and without[4] == p[4]
    assert clean.fit_input_medians(rows.withColumn("c", F.lit(None).cast("double")), ["c"]) == {"c": 0.0}


def test_a_run_writes_seven_tables(spark, folder):
    path, schemas = _run(spark, folder)
    assert set(schemas) == {"initial_quality", "class_statistics", "feature_validation", "split_summary", "split_statistics", "model_comparison", "feature_importance"}
    for name in schemas:
        assert reports.read_report(spark, path, name, schemas).count() > 0
    importance = reports.read_report(spark, path, "feature_importance", schemas)
    assert importance.count() == 89 and abs(importance.agg(F.sum("importance")).first()[0] - 1) < 1e-9


def test_conversion_log(spark):
    before = spark.createDataFrame([(1, "a")], "x int, y string")
    after = before.select(F.col("x").cast("double"), "y")
    assert list(map(tuple, clean.conversion_log(before, after).collect())) == [("x", "int", "double")]
    assert clean.conversion_log(before, before).count() == 0
