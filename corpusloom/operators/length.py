"""Batches of rows of like length, which need little padding.

Rows of a split are numbered by their tokens, the seeded order among equals; a batch is a run
of them, padded to its own longest row.  The files follow the same order, so a reader
of some lengths or batches skips row groups by their statistics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from corpusloom.functions.hashing import order_uniform
from corpusloom.operators.numbering import default_buckets, hash_bucket, number_rows
from corpusloom.session import materialise


def real_tokens(mask: str | Column = "attention_mask") -> Column:
    """Tokens of a row that are not padding."""
    return F.aggregate(mask, F.lit(0), lambda total, m: total + m)


def with_length_batches(df: DataFrame, size: int, key: str = "doc_id") -> DataFrame:
    """Add `batch_id`, `batch_row` and `padded`, the tokens of the batch's longest row.

    `df` has `split` and `tokens` and is read twice.  The last batch of a split may be
    smaller.  A length that many rows share is cut by key hash before it is sorted.
    """
    buckets = max(16, default_buckets(df) // 16)
    placed = number_rows(
        df.withColumn("order_bucket", hash_bucket(F.col(key), buckets)), group=["split"],
        major=["tokens", "order_bucket"], minor=[order_uniform(F.col(key)), key], name="place",
    )
    batched = placed.withColumn("batch_id", F.floor(F.col("place") / size)).withColumn(
        "batch_row", (F.col("place") % size).cast("int")
    )
    whole = Window.partitionBy("split", "batch_id")
    return batched.withColumn("padded", F.max("tokens").over(whole)).drop("order_bucket", "place")


def write_by_length(encoded: DataFrame, path: str, files: int, size: int) -> None:
    """Write encoded rows in batches by length, the ids cut to their batch's width.

    `encoded`, a written dataset, has `doc_id`, `split`, `label`, `input_ids` and
    `attention_mask` and is read twice.  The rows are written once with their batches, so that ranging does not compute them twice.
    """
    rows = encoded.select("doc_id", "split", "label", "input_ids", real_tokens().alias("tokens"))
    batched = with_length_batches(rows, size).withColumn("input_ids", F.slice("input_ids", 1, F.col("padded")))
    placed = materialise(batched, "batches-by-length").repartitionByRange(files, "split", "batch_id")
    ordered = placed.sortWithinPartitions("split", "batch_id", "batch_row")
    ordered.write.mode("overwrite").partitionBy("split").parquet(path)


def read_by_length(
    spark: SparkSession, path: str, least: int | None = None, most: int | None = None
) -> DataFrame:
    """Batches whose width is between the bounds; row groups of others are not read."""
    rows = spark.read.parquet(path)
    if least is not None:
        rows = rows.filter(F.col("padded") >= least)
    if most is not None:
        rows = rows.filter(F.col("padded") <= most)
    return rows


def padding_share(rows: DataFrame) -> DataFrame:
    """Per split the share of stored tokens that are padding."""
    return rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), (1 - F.sum("tokens") / F.sum("padded")).alias("padding")
    )
