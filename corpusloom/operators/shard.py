"""Shards of a file-based dataset: contiguous ranges of its sorted files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

DROP_REMAINDER = "drop_remainder"
LAST_TAKES_REST = "last_takes_rest"


def file_positions(files: int, rank: int, world: int, policy: str = LAST_TAKES_REST) -> list[int]:
    """The sorted file positions that rank `rank` of `world` reads."""
    share = files // world
    if policy == DROP_REMAINDER:
        owner = lambda position: position // (share or 1)
    elif policy == LAST_TAKES_REST:
        owner = lambda position: min(position // share, world - 1) if share else world - 1
    else:
        raise ValueError(f"unknown shard policy {policy!r}")
    return [position for position in range(files) if owner(position) == rank]


def shard_of_file(position: Column, files: Column, world: int, policy: str) -> Column:
    """Shard of a file by its sorted position; null for files no rank reads."""
    if policy == DROP_REMAINDER:
        shard = F.floor(position / F.greatest(F.lit(1), F.floor(files / world)))
        return F.when(shard < world, shard).cast("int")
    if policy == LAST_TAKES_REST:
        share = F.floor(files / world)
        # Fewer files than ranks: a zero share leaves all of them to the last rank.
        shard = F.when(share > 0, F.floor(position / F.nullif(share, F.lit(0)))).otherwise(world - 1)
        return F.least(shard, F.lit(world - 1)).cast("int")
    raise ValueError(f"unknown shard policy {policy!r}")


def count_file_rows(df: DataFrame, group: str = "split", file: str = "file") -> DataFrame:
    """Rows of every file; combined map-side, so as many rows out as there are files."""
    return df.groupBy(F.col(group).alias("split"), F.col(file).alias("file")).agg(
        F.count(F.lit(1)).alias("file_rows")
    )


def shard_layout(file_rows: DataFrame, world: int, policy: str = LAST_TAKES_REST) -> DataFrame:
    """Where each file goes: `(split, file, file_rows, file_position, shard, file_start)`.

    `file_start` is the number of rows before the file in its shard.  Files that no rank
    reads are left out.  Everything about shards and batches follows from this table, one
    row per file; write it once (`materialise`) and join rows to it.
    """
    of_split = Window.partitionBy("split")
    placed = file_rows.withColumns({
        "file_position": F.row_number().over(of_split.orderBy("file")) - 1,
        "files": F.count(F.lit(1)).over(of_split),
    })
    placed = placed.withColumn("shard", shard_of_file(F.col("file_position"), F.col("files"), world, policy))
    before = (
        Window.partitionBy("split", "shard").orderBy("file_position")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.coalesce(F.sum("file_rows").over(before), F.lit(0))
    return placed.drop("files").filter("shard is not null").withColumn("file_start", start)


def with_shard(df: DataFrame, layout: DataFrame) -> DataFrame:
    """Add `file_position` and `shard`; rows of files that no rank reads are left out.

    A written layout has a known size, so Spark broadcasts it while it is small; beyond
    that rows meet it by file, and files are even.
    """
    return df.join(layout.select("split", "file", "file_position", "shard"), ["split", "file"])
