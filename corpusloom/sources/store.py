"""The append-only corpus store and named collections, for any Spark format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def append(df: DataFrame, path: str | None, fmt: str = "parquet", **options) -> None:
    """Append rows to the store; a connector that has no path takes its target as options."""
    df.write.format(fmt).options(**options).mode("append").save(path)


def append_run(df: DataFrame, path: str, run_id: str, fmt: str = "parquet", **options) -> None:
    """Add a run's rows to the store under its `run_id=` folder.

    A plain append doubles the corpus when a run is repeated; a repeated run replaces its
    own rows here and leaves those of other runs alone.
    """
    df.write.format(fmt).options(**options).mode("overwrite").save(f"{path}/run_id={run_id}")


def read(
    spark: SparkSession, path: str | None, schema: StructType | str | None = None,
    fmt: str = "parquet", **options,
) -> DataFrame:
    """Read the store back, with a declared schema if one is given."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def overwrite_named(df: DataFrame, root: str, name: str, fmt: str = "parquet", **options) -> str:
    """Replace the collection `name` under `root`; returns its path."""
    path = f"{root}/{name}"
    df.write.format(fmt).options(**options).mode("overwrite").save(path)
    return path


def export_json_sample(df: DataFrame, path: str, key: str = "doc_id", rows: int = 200) -> None:
    """Write the first `rows` rows by key as JSON lines, for reading by eye."""
    df.orderBy(key).limit(rows).write.mode("overwrite").json(path)
