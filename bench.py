"""Headline jobs, timed once each after one warm-up query; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [quick]

``quick`` leaves out the boosting fit.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from wardline.operators import balance, evaluate, explain, explore, model, profile  # noqa: E402
from wardline.operators.encode import fit_scaler, scale  # noqa: E402
from wardline.operators.features import engineer  # noqa: E402
from wardline.operators.split import stratified_split  # noqa: E402
from wardline.plans import stages  # noqa: E402
from wardline.plans.catalogue import all_queries  # noqa: E402
from wardline.plans.catalogue.scoring import predictions  # noqa: E402
from wardline.plans.model_table import SCALED, encode_rows, model_columns  # noqa: E402
from wardline.plans.prepare import binary_target, prepare  # noqa: E402
from wardline.session import collect_together, local_session, staged  # noqa: E402
from wardline.sources.layout import CLASSES, KEY, NUMERIC  # noqa: E402


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    quick = "quick" in sys.argv[1:]
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    times: dict[str, float] = {}
    made: dict[str, object] = {}

    def timed(name, run):
        start = time.perf_counter()
        made[name] = run()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)

    raw = stages.raw(spark, folder)
    drain(raw.groupBy("readmitted").count())

    # Raw rows to imputed, typed, distinct, winsorised rows on disk.
    timed("prepare_table", lambda: prepare(raw)[0])
    rows = made["prepare_table"]

    def exploration():
        """Every exploratory section over the prepared table."""
        coded = stages.class_code(rows)
        back = explore.returned(F.col("readmitted"))
        collect_together([
            lambda: explore.class_shares(rows, "readmitted"),
            lambda: explore.imbalance(rows, "readmitted"),
            lambda: explore.cross_tab(rows, "age", "readmitted", CLASSES),
            lambda: explore.rate_by(rows, "gender", back),
            lambda: explore.rate_by(rows, "race", back),
            lambda: explore.cross_tab(rows, "gender", "readmitted", CLASSES),
            lambda: explore.top_values(rows, "diag_1", 15),
            lambda: explore.top_values(rows, "diag_2", 15),
            lambda: explore.top_values(rows, "diag_3", 15),
            lambda: explore.histogram(rows, NUMERIC, 30),
            lambda: explore.histogram(rows, ["number_diagnoses"], 15, "readmitted"),
            lambda: explore.box_stats(rows, "num_procedures", "readmitted"),
            lambda: explore.box_stats(rows, "time_in_hospital", "readmitted"),
            lambda: explore.correlation_matrix(rows, NUMERIC),
            lambda: explore.target_correlations(coded, NUMERIC, "target_code"),
            lambda: explore.class_stats(rows, NUMERIC, "readmitted"),
        ])

    timed("exploration_stage", exploration)
    timed("feature_table", lambda: staged(engineer(rows), "featured"))
    featured = made["feature_table"]
    timed("feature_validation", lambda: profile.feature_validation(
        stages.class_code(featured), featured.columns[50:], "target_code").collect())

    def split_scale_write():
        coded = staged(encode_rows(binary_target(featured)), "encoded")
        parts = stratified_split(coded, KEY, "label")
        fitted = fit_scaler(parts.where(F.col("split") == "train"), SCALED)
        return staged(scale(parts, fitted), "scaled", ("split",))

    timed("split_scale_write", split_scale_write)
    scaled = made["split_scale_write"]
    features = model_columns(scaled)
    train = model.kept_for_fit(scaled.where(F.col("split") == "train"))
    test = scaled.where(F.col("split") == "test")
    timed("balance_training_rows", lambda: staged(
        balance.balance(train, KEY, "label", features), "balanced"))
    ready = model.kept_for_fit(train, features)  # assembled within the first fit
    timed("fit_logistic", lambda: model.fit_logistic(ready, features))
    timed("fit_forest", lambda: model.fit_forest(ready, features))
    if not quick:
        timed("fit_boosting", lambda: model.fit_boosting(ready, features))
    ready.unpersist()
    models = {n: made[n] for n in ("fit_logistic", "fit_forest", "fit_boosting") if n in made}

    def evaluation():
        kept = staged(model.predict_all(models, test, features, KEY), "predictions")
        return evaluate.best_models(evaluate.compare_models(kept)).collect()

    timed("evaluate_models", evaluation)
    forest = made["fit_forest"]
    timed("permutation_importance", lambda: explain.permutation_importance(
        forest, test, features, KEY).collect())
    top = [r["feature"] for r in explain.impurity_importance(
        test, forest, features).limit(explain.TOP_DEPENDENCE).collect()]
    timed("partial_dependence", lambda: explain.partial_dependence(
        forest, test, features, top).collect())

    queries = all_queries()
    for name in ("prf02_null_profile", "prf04_describe_lineitem", "out01_outlier_report_lineitem",
                 "agg06_class_stats_lineitem", "cln04_distinct_rows", "cln04_distinct_whole_rows", "prf03_duplicate_rows", "scr01_rule_score",
                 "win05_latest_per_patient", "scr09_merged_feed", "txt01_topic_counts"):
        timed(name, lambda n=name: drain(queries[n](spark, folder)))
    scored = predictions(spark, folder)
    timed("roc_auc_three_scores", lambda: evaluate.roc_auc(evaluate.score_steps(scored)).collect())

    print(json.dumps({
        "metric": "total seconds of the headline jobs", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": Path(folder).name, "cpus": cpus,
        "rows": raw.count(),
    }))


if __name__ == "__main__":
    main()
