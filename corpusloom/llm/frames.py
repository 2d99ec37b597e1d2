"""Joins and groups that hold for hot keys, and other helpers of the operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.session import BATCH_ROWS, parallelism, small_batches  # noqa: F401

# A side is broadcast only if counted below this many rows of a few bytes each.
BROADCAST_ROWS = 500_000
# Parts a hot key's rows are spread over in a join.
SALTS = 8


def spread_join(left: DataFrame, right: DataFrame, on: str, how: str = "left", salts: int = SALTS) -> DataFrame:
    """`left` joined to at most one row of `right` per key, hot keys spread over tasks.

    Rows of a key go to `salts` parts by the hash of their other columns; the one row of
    the right goes to each part.
    """
    others = [c for c in left.columns if c != on]
    salt = F.pmod(F.xxhash64(*others), F.lit(salts)).cast("int") if others else F.lit(0)
    parts = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return (
        left.withColumn("_salt", salt)
        .join(right.withColumn("_salt", parts), [on, "_salt"], how)
        .drop("_salt")
    )


def few(df: DataFrame, bound: int = BROADCAST_ROWS) -> bool:
    """Whether a frame has at most `bound` rows; reads no more than it must."""
    return df.limit(bound + 1).count() <= bound


def without_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is not in `keys`; `df` stays in place while the keys are few."""
    return df.join(F.broadcast(keys) if few(keys) else keys, on, "left_anti")


def with_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is in `keys`; `df` stays in place while the keys are few."""
    return df.join(F.broadcast(keys) if few(keys) else keys, on, "left_semi")


def by_key(df: DataFrame, *keys: str, then: tuple[str, ...] = ()) -> DataFrame:
    """Rows of a key next to each other in one partition."""
    placed = df.repartition(parallelism(df.sparkSession), *keys)
    return placed.sortWithinPartitions(*keys, *then)


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The runs of equal `key` of sorted rows; at most one group is held."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_pylist()
        start = 0
        for at, value in enumerate(keys):
            if held or at > start:
                if value != last:
                    if at > start:
                        held.append(batch.slice(start, at - start))
                    yield pa.Table.from_batches(held)
                    held, start = [], at
            last = value
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def scan_groups(schema: pa.Schema, rows: Iterator[dict], size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Result rows as batches."""
    part: list[dict] = []
    for row in rows:
        part.append(row)
        if len(part) >= size:
            yield pa.RecordBatch.from_pylist(part, schema)
            part = []
    yield pa.RecordBatch.from_pylist(part, schema)
