"""Encoded datasets on disk: one write for all splits, file-ordered scans, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.functions.hashing import file_number, order_uniform
from corpusloom.operators.shard import LAST_TAKES_REST, file_positions
from corpusloom.schemas import MANIFEST, SPLITS


def arrange(df: DataFrame, files: int, key: str = "doc_id") -> DataFrame:
    """Rows in the partition of their file, in the order they are to be written.

    One shuffle serves all splits.  The file follows from the key, so files are even for
    any key, and a re-run task writes the same rows in the same order.
    """
    placed = df.repartitionById(files, file_number(F.col(key), files))
    return placed.sortWithinPartitions("split", order_uniform(F.col(key)), key)


def write_arranged(df: DataFrame, path: str) -> None:
    """Write arranged rows of all splits at once, under `split=` folders."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def scan(spark: SparkSession, path: str) -> DataFrame:
    """A written dataset with each row's file name and place in the file.

    File names sort in file-number order.  Selecting neither column reads neither.
    """
    data = spark.read.parquet(path)
    return data.select(
        "*",
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("row_in_file"),
    )


def sorted_files(spark: SparkSession, path: str, split: str) -> list[str]:
    """The dataset's files of one split in sorted order; an error if there are none."""
    files = sorted(spark.read.parquet(path).filter(F.col("split") == split).inputFiles())
    files = [f for f in files if f"/split={split}/" in f]
    if not files:
        raise ValueError(f"no Parquet files of split {split!r} in {path}")
    return files


def read_shard(
    spark: SparkSession, path: str, split: str, rank: int, world: int,
    policy: str = LAST_TAKES_REST,
) -> DataFrame:
    """The rows of one rank, reading that rank's files only; no rows if it has none."""
    files = sorted_files(spark, path, split)
    mine = [files[i] for i in file_positions(len(files), rank, world, policy)]
    reader = spark.read.option("basePath", path)
    if not mine:
        return reader.parquet(files[0]).limit(0)
    return reader.parquet(*mine)


def split_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows per split; reads file footers and folder names only."""
    return spark.read.parquet(path).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


def record_manifest(spark: SparkSession, manifest: str, run_id: str, path: str, request: str = "") -> None:
    """Append one manifest row per split of a finished dataset, also for empty ones.

    `request` says what the dataset was made from and how.
    """
    splits = spark.createDataFrame([(s,) for s in SPLITS], "split string")
    rows = splits.join(split_rows(spark, path), "split", "left").select(
        F.lit(run_id).alias("run_id"), "split", F.lit(path).alias("path"),
        F.current_timestamp().alias("created_at"), F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
        F.lit(request).alias("request"),
    )
    rows.coalesce(1).write.mode("append").parquet(manifest)


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(manifest)


def complete_runs(manifest: DataFrame, splits: tuple[str, ...] = SPLITS) -> DataFrame:
    """Runs that have every split, with the newest path and the rows of each split.

    All prefixes or nothing: a run that lacks a split is not offered.
    """
    newest = F.struct("created_at", "path", "rows")
    latest = manifest.filter(F.col("split").isin(*splits)).groupBy("run_id", "split").agg(
        F.max(newest).alias("newest")
    )
    whole = latest.groupBy("run_id").agg(
        F.max("newest.created_at").alias("created_at"),
        *[F.max(F.when(F.col("split") == s, F.col("newest.path"))).alias(f"{s}_path") for s in splits],
        F.count(F.lit(1)).alias("splits"),
        F.sum("newest.rows").alias("rows"),
    )
    return whole.filter(F.col("splits") == len(splits)).drop("splits")


def find_cached(manifest: DataFrame, request: str) -> dict | None:
    """The newest complete run of the same request, or None."""
    runs = complete_runs(manifest.filter(F.col("request") == request)).orderBy(F.desc("created_at"), F.desc("run_id")).limit(1)
    found = runs.collect()
    return found[0].asDict() if found else None
