"""Losses and gradients of a linear head, summed over a whole dataset in one pass.

Each task reduces its rows to one K x (D + 1) sum per Arrow stream, so what is shuffled
grows with the model and the number of tasks, never with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from corpusloom.functions.head import Features, losses, scores
from corpusloom.schemas import TRAIN

PARTIAL = "split string, k int, j int, value double"
# `k` of the metric rows, and their places `j`.
METRIC, ROWS, LOSS, CORRECT = -1, 0, 1, 2


def batch_gradient(
    features: Features, column: pa.Array, label: np.ndarray, weights: np.ndarray
) -> tuple[float, float, np.ndarray]:
    """Rows, loss sum and gradient sum of one batch of training rows."""
    z, x = scores(features, column, weights)
    loss, e, total = losses(z, label)
    error = e / total[:, None]
    error[np.arange(len(label)), label] -= 1.0
    gradient = np.zeros_like(weights)
    if features.hashed:
        row, bucket = x
        for k in range(len(weights)):
            gradient[k, :-1] = np.bincount(bucket, error[row, k], features.dim)
    else:
        gradient[:, :-1] = error.T @ x
    gradient[:, -1] = error.sum(axis=0)
    return float(len(label)), float(loss.sum()), gradient


def partial_sums(df: DataFrame, features: Features, weights: np.ndarray) -> DataFrame:
    """Per task: row count, loss sum and correct count by split, and the summed gradient
    of the training rows.  `df` has `split`, `label` and the feature column."""

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gradient = np.zeros_like(weights)
        metrics: dict[str, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            z, x = scores(features, batch.column(features.column), weights)
            label = batch.column("label").to_numpy()
            each = np.arange(len(label))
            loss, e, total = losses(z, label)
            correct = (z.argmax(axis=1) == label).astype(np.float64)

            coded = batch.column("split").dictionary_encode()
            code, names = coded.indices.to_numpy(), coded.dictionary.to_pylist()
            for at, name in enumerate(names):
                of_split = code == at
                sums = np.array([of_split.sum(), loss[of_split].sum(), correct[of_split].sum()])
                metrics[name] = metrics.get(name, 0) + sums

            if TRAIN in names:
                error = e / total[:, None]
                error[each, label] -= 1.0
                error[code != names.index(TRAIN)] = 0.0
                if features.hashed:
                    row, bucket = x
                    for k in range(len(weights)):
                        gradient[k, :-1] += np.bincount(bucket, error[row, k], features.dim)
                else:
                    gradient[:, :-1] += error.T @ x
                gradient[:, -1] += error.sum(axis=0)

        rows = [(s, METRIC, j, float(v)) for s, sums in metrics.items() for j, v in enumerate(sums)]
        rows += [(TRAIN, int(k), int(j), float(gradient[k, j])) for k, j in zip(*np.nonzero(gradient))]
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        types = [pa.string(), pa.int32(), pa.int32(), pa.float64()]
        arrays = [pa.array(c, t) for c, t in zip(columns, types)]
        yield pa.RecordBatch.from_arrays(arrays, ["split", "k", "j", "value"])

    narrow = df.select("split", "label", features.column)
    return narrow.mapInArrow(reduce_rows, PARTIAL)


def summed(partials: DataFrame) -> DataFrame:
    return partials.groupBy("split", "k", "j").agg(F.sum("value").alias("value"))


def gradient(df: DataFrame, features: Features, weights: np.ndarray) -> DataFrame:
    """`(k, j, gradient)` of the mean training loss; zero entries are left out."""
    sums = summed(partial_sums(df, features, weights)).filter(F.col("split") == TRAIN)
    is_count = (F.col("k") == METRIC) & (F.col("j") == ROWS)
    # The window sees the model's entries and three metrics, not the rows.
    rows = F.max(F.when(is_count, F.col("value"))).over(Window.partitionBy("split"))
    entries = sums.withColumn("rows", rows).filter(F.col("k") != METRIC)
    return entries.select("k", "j", (F.col("value") / F.col("rows")).alias("gradient"))


def evaluate_pass(df: DataFrame, features: Features, weights: np.ndarray):
    """Run one pass: the mean training gradient (None without training rows) and, per
    split, `(rows, mean loss, accuracy)`.  Collects K x (D + 1) sums."""
    grad = np.zeros_like(weights)
    sums: dict[str, list[float]] = {}
    for split, k, j, value in summed(partial_sums(df, features, weights)).collect():
        if k == METRIC:
            sums.setdefault(split, [0.0, 0.0, 0.0])[j] = value
        else:
            grad[k, j] = value
    metrics = {s: (int(v[ROWS]), v[LOSS] / v[ROWS], v[CORRECT] / v[ROWS]) for s, v in sums.items()}
    if TRAIN not in metrics:
        return None, metrics
    return grad / metrics[TRAIN][0], metrics
