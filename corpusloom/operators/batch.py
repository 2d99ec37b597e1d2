"""Mini-batches of a shard and the batch counts the ranks agree on.

All counts come from the file layout, one row per file; rows are touched once, to give
each its place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from corpusloom.functions.hashing import order_uniform
from corpusloom.operators.numbering import default_buckets, hash_bucket, number_rows

# Which batches to keep: all of them, only whole ones, or only as many whole ones as the
# rank with the fewest can supply.
KEEP_ALL, DROP_LAST, MATCHED = "keep_all", "drop_last", "matched"


def batch_counts(layout: DataFrame, batch_size: int, drop_last: bool = True) -> DataFrame:
    """Batches per shard."""
    per_shard = F.sum("file_rows") / batch_size
    batches = F.floor(per_shard) if drop_last else F.ceil(per_shard)
    return layout.groupBy("split", "shard").agg(batches.cast("long").alias("batches"))


def batch_size_for(layout: DataFrame, split: str, batches: int) -> int:
    """The least batch size with which every shard of a split has at most `batches` batches."""
    per_shard = layout.filter(F.col("split") == split).groupBy("shard").agg(F.sum("file_rows").alias("rows"))
    rows = per_shard.agg(F.max("rows")).first()[0] or 1
    return -(-rows // batches)


def min_batch_counts(layout: DataFrame, batch_size: int, world: int, drop_last: bool = True) -> DataFrame:
    """The least batch count over ranks, per split; a rank without files supplies none."""
    counts = batch_counts(layout, batch_size, drop_last)
    fewest = F.when(F.count(F.lit(1)) < world, 0).otherwise(F.min("batches")).cast("long")
    return counts.groupBy("split").agg(fewest.alias("min_batches"))


def batch_layout(
    layout: DataFrame, batch_size: int, world: int, keep: str = KEEP_ALL, allow_none: bool = False
) -> DataFrame:
    """The layout with `batch_limit`, the number of batches kept of each shard.

    `MATCHED` raises when it would keep no batch of any split, as with fewer files than
    ranks, unless `allow_none`.
    """
    shard_rows = F.sum("file_rows").over(Window.partitionBy("split", "shard"))
    whole = layout.withColumn("batch_limit", F.floor(shard_rows / batch_size).cast("long"))
    if keep == KEEP_ALL:
        return layout.withColumn("batch_limit", F.lit(None).cast("long"))
    if keep == DROP_LAST:
        return whole
    if keep == MATCHED:
        fewest = min_batch_counts(layout, batch_size, world).withColumnRenamed("min_batches", "batch_limit")
        if not allow_none and fewest.filter("batch_limit > 0").isEmpty():
            raise ValueError("a rank has no whole batch: use fewer ranks or keep all batches")
        return layout.join(fewest, "split")
    raise ValueError(f"unknown batch policy {keep!r}")


def with_row_in_file(df: DataFrame, key: str = "doc_id", buckets: int | None = None) -> DataFrame:
    """Add `row_in_file`, a row's place in the order its file is written in.

    For rows that were not scanned from files.  `buckets` cuts each file's rows for
    numbering, so a task never sorts a whole file of a plan with few files.
    """
    buckets = buckets or default_buckets(df)
    numbered = number_rows(
        df.withColumn("order_bucket", hash_bucket(F.col(key), buckets)),
        group=["split", "file"],
        major=["order_bucket"],
        minor=[order_uniform(F.col(key)), key],
        name="row_in_file",
    )
    return numbered.drop("order_bucket")


def with_batches(
    df: DataFrame, layout: DataFrame, batch_size: int, key: str = "doc_id", buckets: int | None = None
) -> DataFrame:
    """Add `shard`, `row_in_shard` and `batch_id`, keeping the layout's batches.

    `layout` comes from `batch_layout`.  Scanned rows bring `row_in_file` and are not
    shuffled; other rows are numbered first.
    """
    rows = df if "row_in_file" in df.columns else with_row_in_file(df, key, buckets)
    places = layout.select("split", "file", "shard", "file_start", "batch_limit")
    number = (F.col("file_start") + F.col("row_in_file")).cast("long")
    batched = rows.join(places, ["split", "file"]).withColumn("row_in_shard", number).withColumn(
        "batch_id", F.floor(F.col("row_in_shard") / batch_size).cast("long")
    )
    kept = batched.filter(F.col("batch_limit").isNull() | (F.col("batch_id") < F.col("batch_limit")))
    return kept.drop("file_start", "row_in_file", "batch_limit")
