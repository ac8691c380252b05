"""Work that must not grow faster than the tables: what is broadcast, and how often rows are read."""

from pyspark.sql import functions as F

from wardline.operators import clean
from wardline.operators.encode import label_codes, label_encode
from wardline.plans import stages
from wardline.plans.catalogue import exploring, features
from wardline.sources.layout import KEY


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sides_with_a_row_an_encounter_are_not_broadcast(spark, monkeypatch, tmp_path):
    """Their files are under the limit of a broadcast, as those of many rows can be too."""
    def stored(rows, schema):
        path = f"{tmp_path}/{len(list(tmp_path.iterdir()))}"
        spark.createDataFrame(rows, schema).write.parquet(path)
        return spark.read.parquet(path)

    made = stored([(1, 2, 45.0, 0), (2, 0, 55.0, 1), (2, 0, 55.0, 1)],
                  f"{KEY} bigint, comorbidity_index int, age_midpoint double, label int")
    monkeypatch.setattr(exploring.stages, "labelled", lambda *_: made)
    found = exploring.jn03_label_alignment(spark, "-")
    assert "Broadcast" not in plan(found)
    assert sorted(map(tuple, found.collect())) == [(1, 2, 45.0, 0)] + 4 * [(2, 0, 55.0, 1)]

    raw = stored([(1, "250.5"), (2, None), (3, "V57"), (4, "300")], f"{KEY} bigint, diag_2 string")
    split = stored([(k, s) for k, s in enumerate(("train", "test", "val", "train"), 1)], f"{KEY} bigint, split string")
    monkeypatch.setattr(stages, "raw", lambda *_: raw)
    monkeypatch.setattr(features, "split_rows", lambda *_: split)
    found = features.cln06_model_input_impute(spark, "-")
    assert "Broadcast" not in plan(found)
    assert sorted((r[KEY], r["diag_2"], r["split"]) for r in found.collect()) == [
        (1, 250.5, "train"), (2, 275.25, "test"), (3, 275.25, "val"), (4, 300.0, "train")]


def test_label_codes_read_the_rows_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(v):
        read.add(1)
        return v

    kept = F.udf(seen, "string").asNondeterministic()
    rows = spark.createDataFrame([(i, "ab"[i % 2], None if i % 3 else "x") for i in range(60)], "k int, p string, q string")
    codes = label_codes(rows.withColumn("p", kept("p")), ["p", "q"])
    coded = label_encode(rows, ["p", "q"], codes).orderBy("k").collect()
    assert [tuple(r) for r in coded[:4]] == [(0, 0, 1), (1, 1, 0), (2, 0, 0), (3, 1, 1)]
    assert read.value <= 60


def test_whole_rows_are_grouped_only_where_a_key_comes_twice(spark):
    schema = "k bigint, v string, x double, _gap_v int"
    rows = [(1, "a", 0.5, 0), (2, None, None, 1), (2, None, None, 1), (3, "a", 1.0, 0), (3, "b", 1.0, 0), (3, "b", 1.0, 1),
            (None, "n", None, 0), (None, "n", None, 0), (None, None, 2.0, 1), (4, "b", -0.0, 0), (4, "b", 0.0, 0), (5, None, float("nan"), 1)]
    df = spark.createDataFrame(rows, schema)
    plain = sorted(map(repr, df.drop("_gap_v").distinct().collect()))
    for most in (1, 3, 500):  # over the bound all rows are grouped
        assert sorted(map(repr, clean.distinct_rows(df.drop("_gap_v"), "k", most).collect())) == plain
        counted = clean.counted_rows(df, ["_gap_v"], "k", most)
        assert [t for _, t in counted.dtypes[-2:]] == ["bigint", "bigint"]
        assert sorted(repr(r[:3]) for r in counted.collect()) == sorted(repr(r[:3]) for r in df.drop("_gap_v").distinct().collect())
        assert {(r["k"], r["v"]): (r["_copies"], r["_gap_v"]) for r in counted.collect()} == {
            (1, "a"): (1, 0), (2, None): (2, 2), (3, "a"): (1, 0), (3, "b"): (2, 1), (None, "n"): (2, 0),
            (None, None): (1, 1), (4, "b"): (2, 0), (5, None): (1, 1)}
    once = df.where("k in (1, 5)")
    assert "Exchange" not in plan(clean.distinct_rows(once, "k")) + plan(clean.counted_rows(once, ["_gap_v"], "k"))
