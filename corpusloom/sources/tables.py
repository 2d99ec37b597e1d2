"""Readers for the labelled corpora."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusloom.schemas import IN_DOMAIN, LABELLED, OUT_DOMAIN, TABLES
from corpusloom.session import path_bytes, qualified


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table under `folder`, with its declared schema."""
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


# Text tables below this size per core are spread before text work.
SPREAD_BYTES = 8 * 1024 * 1024


def read_texts(
    spark: SparkSession, folder: str, name: str, key: str = "doc_id", spread: bool | None = None
) -> DataFrame:
    """A text table for row-wise work on every core; the rows are the same either way.

    A small file is often one row group, which is one task however many cores there are;
    `spread` deals such a table out by key.  Left open, tables below `SPREAD_BYTES` per
    core are spread.  Filters and column selection still reach the scan.
    """
    table = read_table(spark, folder, name)
    cores = spark.sparkContext.defaultParallelism
    if spread is None:
        spread = path_bytes(spark, f"{folder}/{name}.parquet") < SPREAD_BYTES * cores
    return table.repartition(cores, key) if spread else table


def tag(df: DataFrame, source: str) -> DataFrame:
    """Add the literal corpus tag."""
    return df.withColumn("source", F.lit(source))


def typed(df: DataFrame) -> DataFrame:
    """Bring columns to the labelled-row types, in schema order."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in LABELLED.fields])


def stack(*frames: DataFrame) -> DataFrame:
    """Bag union by column name; nothing is removed."""
    return reduce(DataFrame.unionByName, frames)


def read_corpus(
    spark: SparkSession,
    paths: list[str],
    source: str,
    text_column: str = "text",
    key_column: str | None = None,
    label_column: str = "label",
    fmt: str = "parquet",
    schema: str | None = None,
    **options,
) -> DataFrame:
    """A labelled corpus from its split folders: read, stack, rename, cast, tag.

    Give text formats a `schema`, or Spark reads them once more to infer one.  Without a
    `key_column` the key is derived, and differs between parts.  A given key must be
    unique over all parts; that is checked by a pass over the keys.
    """
    reader = spark.read.format(fmt).options(**options)
    reader = reader.schema(schema) if schema else reader
    names = [F.col(text_column).alias("text"), F.col(label_column).alias("label")]
    parts = []
    for number, path in enumerate(paths):
        part = reader.load(path)
        if key_column is not None:
            parts.append(part.select(F.col(key_column).alias("doc_id"), *names))
        elif fmt == "parquet":
            place = F.xxhash64(F.lit(number), _below(spark, path), F.col("_metadata.row_index"))
            parts.append(part.select(place.alias("doc_id"), *names))
        else:
            parts.append(_keyed_by_content(part.select(*names), number))
    frame = stack(*parts)
    if key_column is not None:
        check_keys(frame)
    return typed(tag(frame, source))


def _below(spark: SparkSession, root: str) -> Column:
    """A row's file as its path below `root`: folders can have files of one name.

    The key thus stays when a corpus moves as a whole.  A root with wildcards has no one
    place; there it is the whole path.
    """
    file = F.col("_metadata.file_path")
    if any(c in root for c in "*?[{"):
        return file
    return F.substring(file, len(qualified(spark, root)) + 1, 2**31 - 1)


def _keyed_by_content(df: DataFrame, part: int) -> DataFrame:
    """Rows with a key from their content and, among equal rows, their number."""
    counted = df.groupBy("text", "label").agg(F.count(F.lit(1)).alias("n"))
    each = counted.select("text", "label", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("i"))
    return each.select(F.xxhash64(F.lit(part), "text", "label", "i").alias("doc_id"), "text", "label")


def check_keys(df: DataFrame, key: str = "doc_id") -> None:
    """Raise if a key is null or occurs twice."""
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | F.col(key).isNull())
    first = repeated.select(key).first()
    if first is not None:
        raise ValueError(f"key {first[0]!r} is missing or not unique")


def _joined(spark: SparkSession, folder: str) -> DataFrame:
    # No broadcast hint: labels grow with documents.  Spark broadcasts them while they are
    # under autoBroadcastJoinThreshold and merges on doc_id beyond it.
    documents = read_texts(spark, folder, "documents").select("doc_id", "text", "lang")
    labels = read_table(spark, folder, "labels")
    return documents.join(labels, "doc_id")


def load_in_domain(spark: SparkSession, folder: str) -> DataFrame:
    """English labelled documents as the in-domain corpus."""
    rows = _joined(spark, folder).filter("lang = 'en'")
    return typed(tag(rows.withColumnRenamed("quality", "label"), IN_DOMAIN))


def load_out_domain(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents in other languages as the out-of-domain corpus."""
    rows = _joined(spark, folder).filter("lang <> 'en'")
    return typed(tag(rows.withColumnRenamed("quality", "label"), OUT_DOMAIN))


def load_labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Both corpora in one scan and one join; equals the union of the two loaders."""
    rows = _joined(spark, folder).filter("lang is not null")
    source = F.when(F.col("lang") == "en", IN_DOMAIN).otherwise(OUT_DOMAIN)
    return typed(rows.withColumnRenamed("quality", "label").withColumn("source", source))


def select_source(df: DataFrame, source: str) -> DataFrame:
    """Rows of one corpus."""
    return df.filter(F.col("source") == source)
