"""A linear softmax head: logits, loss and predicted class of whole batches.

Weights are a K x (D + 1) matrix; the last column is the bias.  Features are either a
dense `array<float>` of length D, or an id array read as hashed counts with D buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from corpusloom.schemas import PAD


@dataclass(frozen=True)
class Features:
    """Where the frozen features are: `column`, `dim` wide, dense or hashed ids."""

    column: str
    dim: int
    hashed: bool = False


def scores(features: Features, column: pa.Array, weights: np.ndarray):
    """Logits of a batch, and the features in the form that the gradient needs.

    Raises on a null row or a dense vector of another length than the weights expect.
    """
    if column.null_count:
        raise ValueError(f"null {features.column}")
    dim = weights.shape[1] - 1
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if features.hashed:
        row = np.repeat(np.arange(len(column)), sizes)
        real = values != PAD
        row, bucket = row[real], values[real] % dim
        z = np.stack([np.bincount(row, w[bucket], len(column)) + w[-1] for w in weights], axis=1)
        return z, (row, bucket)
    if (sizes != dim).any():
        raise ValueError(f"{features.column} must have {dim} numbers")
    x = values.astype(np.float64).reshape(len(column), dim)
    return x @ weights[:, :-1].T + weights[:, -1], x


def losses(z: np.ndarray, label: np.ndarray):
    """Cross entropy of each row, its exponentials and their sum; NaN logits give NaN."""
    top = z.max(axis=1, keepdims=True)
    e = np.exp(z - top)
    total = e.sum(axis=1)
    return top[:, 0] + np.log(total) - z[np.arange(len(label)), label], e, total


def with_scores(df: DataFrame, features: Features, weights: np.ndarray) -> DataFrame:
    """Add `loss` and `pred`, the class of the largest logit, the first one on ties."""
    names = df.columns
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, _ = scores(features, batch.column(names.index(features.column)), weights)
            label = batch.column(names.index("label")).to_numpy(zero_copy_only=False)
            loss, _, _ = losses(z, label)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(loss), pa.array(z.argmax(axis=1).astype(np.int32))],
                [*names, "loss", "pred"],
            )

    return df.mapInArrow(score, f"{head}, loss double, pred int")
