"""Row numbers within groups, without a whole group in one task.

A plain `row_number` over a group sorts the group in one task.  Here each group is cut
into buckets by a leading column whose order agrees with the wanted order; bucket sizes
are counted (map-side combined), prefix-summed per group, and only rows of one bucket are
ever sorted together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.functions.hashing import order_uniform
from corpusloom.session import parallelism


def default_buckets(df: DataFrame) -> int:
    """Enough buckets that each shuffle partition holds several."""
    return max(64, 4 * parallelism(df.sparkSession))


def hash_bucket(key: Column, buckets: int) -> Column:
    """Order-preserving bucket of the order number; hashed, hence evenly filled."""
    return F.floor(order_uniform(key) * buckets).cast("int")


def bucket_offsets(df: DataFrame, group: list[str], major: list[str]) -> DataFrame:
    """For each (group, major): its row count and the rows of the group before it."""
    before = (
        Window.partitionBy(*(group or [F.lit(0)])).orderBy(*major)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    counts = df.groupBy(*group, *major).agg(F.count(F.lit(1)).alias("bucket_rows"))
    return counts.withColumn("bucket_start", F.coalesce(F.sum("bucket_rows").over(before), F.lit(0)))


def number_rows(
    df: DataFrame,
    group: list[str],
    major: list[str],
    minor: list[str | Column],
    name: str = "row_index",
    below: Column | None = None,
    broadcast_offsets: bool = False,
) -> DataFrame:
    """Add `name`, the 0-based position within `group` in order of (`major`, `minor`).

    `below` keeps only positions under that bound.  Buckets that start at or past it drop
    out in the join with the offsets.  A caller that knows the groups to be few sets
    `broadcast_offsets`: that join then comes before the shuffle, and a small sample of a
    large group moves few rows.

    `df` is read twice, once for its keys alone; pass a written table if it is costly.
    """
    offsets = bucket_offsets(df, group, major).drop("bucket_rows")
    if below is not None:
        offsets = offsets.filter(F.col("bucket_start") < below)
    if broadcast_offsets:
        offsets = F.broadcast(offsets)
    inside = Window.partitionBy(*group, *major).orderBy(*minor)
    # One row per (group, bucket) on the right: Spark broadcasts it while it is small and
    # otherwise merges on the same keys the window partitions by, reusing that shuffle.
    placed = df.join(offsets, [*group, *major]).withColumn(
        name, (F.col("bucket_start") + F.row_number().over(inside) - 1).cast("long")
    )
    if below is not None:
        placed = placed.filter(F.col(name) < below)
    return placed.drop("bucket_start").select(*df.columns, name)
