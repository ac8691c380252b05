"""Fitting the three classifiers, and batch prediction."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from py4j.protocol import Py4JJavaError

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from wardline.operators import tree_scans
from wardline.operators.clean import fill
from wardline.operators.logistic import LogisticFit, load_fit, newton, save_fit
from wardline.session import ROWS_A_TASK

# Hyper-parameters of the classifiers.
LOGISTIC = {"c": 1.0, "max_iter": 1000, "tolerance": 1e-4}
FOREST = {"trees": 200, "depth": 10, "leaf_rows": 2}
BOOSTING = {"trees": 200, "step": 0.05, "depth": 5, "subsample": 0.8}
SEED = 42
# End of fixed values.
# Megabytes of node statistics per pass: more nodes grow in each pass over the rows.
NODE_MEMORY = 1024
#: Up to so many training rows the library grows the trees, above them ``tree_scans`` does.
LIBRARY_ROWS = ROWS_A_TASK


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add the feature vector; a table that has one already is left as it is."""
    if "features" in df.columns:
        return df
    return VectorAssembler(
        inputCols=list(features), outputCol="features", handleInvalid="error").transform(df)


def with_class_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """Weight n / (classes x class size), so both classes count the same."""
    sizes = {r[label]: r["n"] for r in
             df.groupBy(label).agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    weights = F.create_map(*[
        F.lit(v) for c, n in sizes.items() for v in (c, total / (len(sizes) * n))])
    return df.withColumn("weight", weights[F.col(label)])


def fit_logistic(train: DataFrame, features: Sequence[str], label: str = "label",
                 c: float = LOGISTIC["c"], max_iter: int = LOGISTIC["max_iter"],
                 tolerance: float = LOGISTIC["tolerance"]) -> LogisticFit:
    """L2 logistic regression; ``c`` is the inverse penalty on the summed loss."""
    return newton(_vectors(assemble(train, features), label), len(features), c, tolerance, max_iter)


def fit_forest(train: DataFrame, features: Sequence[str], label: str = "label",
               trees: int = FOREST["trees"], depth: int = FOREST["depth"],
               leaf_rows: int = FOREST["leaf_rows"], balanced: bool = True):
    ready = assemble(train, features)
    weights = {"weightCol": "weight"} if balanced else {}
    estimator = RandomForestClassifier(
        labelCol=label, numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf_rows,
        seed=SEED, maxMemoryInMB=NODE_MEMORY, **weights)
    if sizes := _sizes_for_scans(ready, label):
        n = sum(sizes)
        return tree_scans.fit_forest(_vectors(ready, label), estimator, [n / (2 * k) for k in sizes] if balanced else (1.0, 1.0))
    return estimator.fit(with_class_weight(ready, label) if balanced else ready)


def _sizes_for_scans(ready: DataFrame, label: str) -> tuple[int, int] | None:
    """Rows of the classes 0 and 1 where they are all there is and more than the library is given."""
    if ready.count() <= LIBRARY_ROWS:
        return None
    sizes = {r[label]: r["n"] for r in ready.groupBy(label).agg(F.count("*").alias("n")).collect()}
    return (sizes[0], sizes[1]) if set(sizes) == {0, 1} else None


def _vectors(ready: DataFrame, label: str) -> DataFrame:
    return ready.select(vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y"))


def fit_boosting(train: DataFrame, features: Sequence[str], label: str = "label",
                 trees: int = BOOSTING["trees"], step: float = BOOSTING["step"],
                 depth: int = BOOSTING["depth"], subsample: float = BOOSTING["subsample"]):
    ready = assemble(train, features).select("features", label)
    estimator = GBTClassifier(
        labelCol=label, maxIter=trees, stepSize=step, maxDepth=depth,
        subsamplingRate=subsample, seed=SEED, maxMemoryInMB=NODE_MEMORY)
    if _sizes_for_scans(ready, label):
        return tree_scans.fit_boosting(_vectors(ready, label), estimator)
    return estimator.fit(ready)


def predict(model, rows: DataFrame, features: Sequence[str], name: str, key: str,
            label: str = "label") -> DataFrame:
    """(model, key, label, y_pred, y_prob)."""
    scored = model.transform(assemble(rows, features))
    return scored.select(
        F.lit(name).alias("model"), key, label,
        F.col("prediction").cast("int").alias("y_pred"),
        vector_to_array("probability")[1].alias("y_prob"))


def predict_all(models: Mapping[str, object], rows: DataFrame, features: Sequence[str],
                key: str, label: str = "label") -> DataFrame:
    """Long predictions of several models over one assembled table."""
    out = None
    for name, model in models.items():
        part = predict(model, rows, features, name, key, label)
        out = part if out is None else out.unionByName(part)
    return out


def kept_for_fit(df: DataFrame, features: Sequence[str] | None = None, label: str = "label") -> DataFrame:
    """Training rows are read once per pass of a fit; keep them, spilling to disk.

    With ``features`` only their vector and the label are kept, so fits share one assembly. More rows than one task's
    are dealt evenly: a pass ends with its longest task, and files of unequal numbers of rows make unequal tasks.
    """
    kept = df if features is None else assemble(df, features).select("features", label)
    if df.count() > ROWS_A_TASK:
        kept = kept.repartition(max(df.sparkSession.sparkContext.defaultParallelism, kept.rdd.getNumPartitions()))
    return kept.persist(StorageLevel.MEMORY_AND_DISK)


class Scorer(NamedTuple):
    """A fitted model with what its inputs need: the scaler, the order of the features, and the values that fill gaps in
    the scaled inputs; without them a row with a gap has no probability."""

    model: object
    scaler: dict[str, tuple[float, float]]
    features: list[str]
    medians: dict[str, float] = {}


def save_scorer(spark: SparkSession, scorer: Scorer, path: str) -> None:
    save(scorer.model, f"{path}/model")
    rows = [(i, c, *map(float, scorer.scaler.get(c, (0.0, 1.0))), c in scorer.scaler, scorer.medians.get(c))
            for i, c in enumerate(scorer.features)]
    spark.createDataFrame(rows, "place int, feature string, mean double, std double, scaled boolean, median double").coalesce(1).write.parquet(f"{path}/inputs")


def load_scorer(spark: SparkSession, path: str) -> Scorer | None:
    """What is stored at ``path``; nothing where either part is missing."""
    try:
        rows = spark.read.parquet(f"{path}/inputs").orderBy("place").collect()  # one row a feature
        fitted = load(f"{path}/model")
    except (AnalysisException, Py4JJavaError):
        return None
    return Scorer(fitted, {r["feature"]: (r["mean"], r["std"]) for r in rows if r["scaled"]},
                  [r["feature"] for r in rows],
                  {r["feature"]: r["median"] for r in rows if "median" in r and r["median"] is not None})


def probability(scorer: Scorer, inputs: DataFrame) -> DataFrame:
    """Inputs with ``probability``; NULL where a feature is missing, so that no row ends the job."""
    ready = inputs.withColumns({
        c: (F.col(c) - mean) / std for c, (mean, std) in scorer.scaler.items()})
    ready = fill(ready, scorer.medians)
    whole = F.lit(True)
    for c in scorer.features:
        whole = whole & F.col(f"`{c}`").isNotNull()
    filled = ready.withColumn("_whole", whole).fillna(0.0, scorer.features)
    scored = scorer.model.transform(assemble(filled, scorer.features))
    return scored.withColumn("probability", F.when(F.col("_whole"), vector_to_array("probability")[1]))


def save(model, path: str) -> None:
    if isinstance(model, LogisticFit):
        save_fit(model, path)
    else:
        PipelineModel([model]).write().save(path)


def load(path: str):
    try:
        return load_fit(path)
    except AnalysisException:  # no such part: a stored Spark model
        return PipelineModel.load(path).stages[0]
