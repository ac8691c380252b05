"""Logistic regression by Newton steps.

A step needs the loss, its gradient and the weighted Gram matrix of the inputs: one aggregate over the rows, a
few thousand sums whatever their number. Steps do not depend on the inputs' scales, and some six to eight reach
the optimum to full precision.
"""

from __future__ import annotations

import sys
from functools import reduce
from operator import add
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Executors get these functions with the job and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows multiplied at once; rows the start is fitted to, and its steps.
ROWS, SAMPLE, LOCAL_STEPS = 8_192, 20_000, 50


class LogisticFit(NamedTuple):
    """Coefficients and intercept; ``loss`` is the penalised sum at the last scan, of ``scans``."""

    coefficients: tuple[float, ...]
    intercept: float
    loss: float = float("nan")
    scans: int = 0

    def margin(self, x):
        """Log odds of an array column, as one sum."""
        return reduce(add, [F.get(x, F.lit(i)) * float(w) for i, w in enumerate(self.coefficients) if w], F.lit(float(self.intercept)))

    def transform(self, df: DataFrame) -> DataFrame:
        """Rows with ``features`` get ``probability`` (a vector) and ``prediction``."""
        p = 1.0 / (1.0 + F.exp(-self.margin(F.col("_x"))))
        return (df.withColumn("_x", vector_to_array("features")).withColumn("_p", p)
                .withColumn("probability", array_to_vector(F.array(1.0 - F.col("_p"), F.col("_p"))))
                .withColumn("prediction", (F.col("_p") > 0.5).cast("double")).drop("_x", "_p"))


def _sums(x: np.ndarray, y: np.ndarray, beta: np.ndarray):
    """Loss, gradient and Gram matrix of some rows."""
    m = x @ beta
    p = 1.0 / (1.0 + np.exp(-np.clip(m, -700, 700)))
    return float((np.logaddexp(0.0, m) - y * m).sum()), x.T @ (p - y), (x * (p * (1.0 - p))[:, None]).T @ x


def _inputs(batch: pa.RecordBatch | pa.Table, width: int):
    x = np.ones((batch.num_rows, width))
    column = batch.column(0)
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x[:, :-1] = column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width - 1)
    return x, batch.column(1).to_numpy(zero_copy_only=False)


def _partials(beta: np.ndarray):
    width = len(beta)

    def run(batches):
        loss, gradient, gram = 0.0, np.zeros(width), np.zeros((width, width))
        for batch in batches:
            x, y = _inputs(batch, width)
            for i in range(0, len(x), ROWS):
                part = _sums(x[i : i + ROWS], y[i : i + ROWS], beta)
                loss, gradient, gram = loss + part[0], gradient + part[1], gram + part[2]
        values = np.concatenate([[loss], gradient, gram[np.triu_indices(width)]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], ["place", "total"])
    return run


def _scan(rows: DataFrame, beta: np.ndarray):
    width = len(beta)
    sums = rows.mapInArrow(_partials(beta), "place int, total double").groupBy("place").agg(F.sum("total").alias("total")).collect()
    values = np.zeros(1 + width + width * (width + 1) // 2)
    for r in sums:
        values[r["place"]] = r["total"]
    gram = np.zeros((width, width))
    gram[np.triu_indices(width)] = values[1 + width :]
    return values[0], values[1 : 1 + width], gram + np.triu(gram, 1).T


def _descend(sums, beta: np.ndarray, penalty: np.ndarray, tolerance: float, most: int):
    """Newton steps from ``beta``: the end, its loss and how often ``sums`` was asked. A step that raises the loss is halved."""
    step, before = np.zeros(len(beta)), np.inf
    for asked in range(1, most + 1):
        loss, gradient, gram = sums(beta)
        loss += 0.5 * float((penalty * beta * beta).sum())
        if loss > before * (1 + 1e-12) + 1e-12:
            step = step / 2
            beta = beta - step
            continue
        if not gram[-1, -1]:  # no rows, or all of them certain
            return beta, loss, asked
        gradient, before = gradient + penalty * beta, loss
        floor = np.append(np.zeros(len(beta) - 1), 1e-12 * gram[-1, -1])
        step = -np.linalg.solve(gram + np.diag(penalty + floor), gradient)
        beta = beta + step
        if -float(gradient @ step) / 2 < tolerance**2:
            break
    return beta, before, asked


def newton(rows: DataFrame, width: int, c: float, tolerance: float, max_scans: int, sample: int = SAMPLE) -> LogisticFit:
    """Fit ``rows(x array<double>, y double)``: summed log loss plus squared coefficients over ``2 c``; the intercept
    is free. Ends when another step would lower the loss by less than the square of ``tolerance``; that step
    is still taken. Steps begin where a fit to some ``sample`` rows, picked by hash, ends (at zero if 0); it saves scans and
    the result is that of all rows in any case. No rows give zeros."""
    penalty, beta, extra = np.append(np.full(width, 1.0 / c), 0.0), np.zeros(width + 1), 0
    if sample and (n := rows.count()):
        extra = 2
        share = F.pmod(F.xxhash64("x", "y"), F.lit(1 << 40)) < int(min(1.0, sample / n) * (1 << 40))
        x, y = _inputs(rows.where(share).toArrow(), width + 1)
        if len(x):
            def local(b):
                return tuple(v * (n / len(x)) for v in _sums(x, y, b))
            beta = _descend(local, beta, penalty, tolerance, LOCAL_STEPS)[0]
    beta, loss, scans = _descend(lambda b: _scan(rows, b), beta, penalty, tolerance, max_scans)
    return LogisticFit(tuple(beta[:-1].tolist()), float(beta[-1]), float(loss), extra + scans)


def save_fit(fit: LogisticFit, path: str) -> None:
    rows = [(i, float(w)) for i, w in enumerate([*fit.coefficients, fit.intercept])]
    SparkSession.getActiveSession().createDataFrame(rows, "place int, weight double").coalesce(1).write.parquet(f"{path}/logistic")


def load_fit(path: str) -> LogisticFit:
    rows = SparkSession.getActiveSession().read.parquet(f"{path}/logistic").orderBy("place").collect()
    return LogisticFit(tuple(r["weight"] for r in rows[:-1]), rows[-1]["weight"])
