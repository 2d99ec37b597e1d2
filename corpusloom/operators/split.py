"""Seeded order, train/test split and sample caps by key hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.hashing import file_number, order_uniform
from corpusloom.operators.numbering import default_buckets, hash_bucket, number_rows
from corpusloom.schemas import IN_DOMAIN, OUT_TEST, SEED, SPLITS, TEST, TRAIN, TRAIN_FRACTION

# Bucket offsets are broadcast up to this many rows.
BROADCAST_OFFSETS = 1_000_000


def split_name(
    source: Column, key: Column, fraction: float = TRAIN_FRACTION, seed: int = SEED
) -> Column:
    """`train` or `test` for in-domain rows, the out-of-domain test split for the rest."""
    in_domain = source == IN_DOMAIN
    return (
        F.when(in_domain & (order_uniform(key, seed) < fraction), TRAIN)
        .when(in_domain, TEST)
        .otherwise(OUT_TEST)
    )


def with_split(
    df: DataFrame, key: str = "doc_id", fraction: float = TRAIN_FRACTION, seed: int = SEED
) -> DataFrame:
    """Add the `split` column: row-local, no sort and no shuffle."""
    return df.withColumn("split", split_name(F.col("source"), F.col(key), fraction, seed))


def seeded_shuffle(
    df: DataFrame, key: str = "doc_id", group: list[str] | None = None, buckets: int | None = None
) -> DataFrame:
    """Add `row_index`, the position of each row in the seeded random order."""
    buckets = buckets or default_buckets(df)
    numbered = number_rows(
        df.withColumn("order_bucket", hash_bucket(F.col(key), buckets)),
        group=group or [],
        major=["order_bucket"],
        minor=[order_uniform(F.col(key)), key],
    )
    return numbered.drop("order_bucket")


def cap_for_split(samples: int) -> Column:
    """`samples` training rows and a fifth of that, rounded down, of each test split."""
    return F.when(F.col("split") == TRAIN, samples).otherwise(int(samples * 0.2))


def sample_cap(
    df: DataFrame, samples: int | None, key: str = "doc_id", buckets: int | None = None
) -> DataFrame:
    """The first rows of each split in the seeded order; all rows without a cap."""
    if not samples or samples <= 0:
        return df
    buckets = buckets or default_buckets(df)
    capped = number_rows(
        df.withColumn("order_bucket", hash_bucket(F.col(key), buckets)),
        group=["split"],
        major=["order_bucket"],
        minor=[order_uniform(F.col(key)), key],
        below=cap_for_split(samples),
        # One row per split and bucket.
        broadcast_offsets=len(SPLITS) * buckets <= BROADCAST_OFFSETS,
    )
    return capped.select(*df.columns)


def even_partitions(df: DataFrame, partitions: int, key: str = "doc_id") -> DataFrame:
    """`partitions` even partitions, row to partition by key hash.

    Unlike a round-robin repartition this needs no sort to be repeatable after a lost
    task, and the partition a row lands in is known from its key.
    """
    return df.repartitionById(partitions, file_number(F.col(key), partitions))
