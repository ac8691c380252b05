"""Classifier evaluation over a long table of predictions (model, key, label, y_pred, y_prob)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardline.functions.stats import ratio
from wardline.operators.ordering import ONE_TASK_ROWS, running_sums


def confusion(predictions: DataFrame) -> DataFrame:
    actual, said = F.col("label") == 1, F.col("y_pred") == 1
    return predictions.groupBy("model").agg(
        F.count_if(~actual & ~said).alias("tn"), F.count_if(~actual & said).alias("fp"),
        F.count_if(actual & ~said).alias("fn"), F.count_if(actual & said).alias("tp"),
    )


def rates(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 from confusion counts; 0 where undefined."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def share(num, den):
        return F.coalesce(ratio(num, den), F.lit(0.0))

    return counts.select(
        "model",
        share(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def weighted_f1(counts: DataFrame) -> DataFrame:
    """F1 of both classes weighted by class size, and of the positive class."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    positive = F.coalesce(ratio(2 * tp, 2 * tp + fp + fn), F.lit(0.0))
    negative = F.coalesce(ratio(2 * tn, 2 * tn + fp + fn), F.lit(0.0))
    return counts.select(
        "model", positive.alias("f1_positive"),
        ratio(positive * (tp + fn) + negative * (tn + fp), tp + fn + tn + fp)
        .alias("f1_weighted"))


def probability_scores(predictions: DataFrame) -> DataFrame:
    """Brier score and R2 of the probabilities."""
    y, p = F.col("label").cast("double"), F.col("y_prob")
    miss = (y - p) * (y - p)
    return predictions.groupBy("model").agg(
        F.avg(miss).alias("brier"),
        (1 - F.try_divide(F.avg(miss), F.var_pop(y))).alias("r2"),
    )


def score_steps(
    predictions: DataFrame, one_task_rows: int = ONE_TASK_ROWS
) -> DataFrame:
    """(model, y_prob, pos, neg, cum_pos, cum_neg), highest score first.

    Tied scores are one step. Counting per score comes first, so a score shared by
    most rows is one row, and the order is spread over tasks by ``running_sums``.
    """
    steps = predictions.groupBy("model", "y_prob").agg(
        F.count_if(F.col("label") == 1).alias("pos"),
        F.count_if(F.col("label") != 1).alias("neg"),
    )
    return running_sums(steps, ["y_prob"], ["pos", "neg"], ["model"], descending=True,
                        one_task_rows=one_task_rows)


def roc_auc(steps: DataFrame) -> DataFrame:
    """Exact area with ties: a negative loses to every higher positive, and half to equals."""
    wins = F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2)
    return steps.groupBy("model").agg(
        ratio(F.sum(wins), F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc"))


def average_precision(steps: DataFrame) -> DataFrame:
    gain = F.col("pos") * ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))
    return steps.groupBy("model").agg(
        F.try_divide(F.sum(gain), F.sum("pos").cast("double")).alias("average_precision"))


def roc_curve(steps: DataFrame) -> DataFrame:
    """(model, threshold, fpr, tpr) for every distinct score."""
    whole = steps.groupBy("model").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    # One row per model.
    return steps.join(F.broadcast(whole), "model").select(
        "model", F.col("y_prob").alias("threshold"),
        ratio(F.col("cum_neg"), F.col("_n")).alias("fpr"),
        ratio(F.col("cum_pos"), F.col("_p")).alias("tpr"),
    )


def compare_models(predictions: DataFrame, places: int = 4) -> DataFrame:
    """One row of rounded metrics per model, best area first."""
    table = (
        rates(confusion(predictions))
        .join(roc_auc(score_steps(predictions)), "model")
        .join(probability_scores(predictions), "model")
    )
    metrics = ["accuracy", "precision", "recall", "f1", "roc_auc", "brier", "r2"]
    return table.select(
        "model", *[F.round(m, places).alias(m) for m in metrics]
    ).orderBy(F.desc("roc_auc"), "model")


def average_rank(df: DataFrame, column: str, name: str) -> DataFrame:
    """Rank from the largest value; ties share their mean rank.

    For report tables with one row per model, hence a window over all rows.
    """
    ties = F.count("*").over(W.partitionBy(column))
    return df.withColumn(
        name, F.rank().over(W.orderBy(F.desc(column))) + (ties - 1) / F.lit(2.0))


def ranked_models(comparison: DataFrame) -> DataFrame:
    ranked = average_rank(average_rank(comparison, "roc_auc", "rank_auc"), "accuracy", "rank_acc")
    return ranked.withColumn("combined_rank", F.col("rank_auc") + F.col("rank_acc"))


def best_models(comparison: DataFrame) -> DataFrame:
    """Winners by area, by accuracy and by combined rank (ties: area, then name)."""
    ranked = ranked_models(comparison)
    lowest = F.struct("combined_rank", -F.col("roc_auc"), "model")
    return ranked.agg(
        F.min_by("model", F.struct(-F.col("roc_auc"), F.col("model"))).alias("best_auc"),
        F.min_by("model", F.struct(-F.col("accuracy"), -F.col("roc_auc"), F.col("model")))
        .alias("best_accuracy"),
        F.min_by("model", lowest).alias("best_overall"),
    )
