"""Run metrics: timed stages, appended and reported as a table."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timezone
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.schemas import RUN_METRICS

_ARROW = pa.schema([
    ("run_id", pa.string()), ("at", pa.timestamp("us", "UTC")), ("stage", pa.string()), ("cpus", pa.int32()),
    ("files", pa.int32()), ("world", pa.int32()), ("samples", pa.int64()), ("shard", pa.int32()), ("seconds", pa.float64()),
])


class RunLog:
    """Collects one row per timed stage of a run and appends them in one write."""

    def __init__(self, spark: SparkSession, path: str, run_id: str, samples: int = 0,
                 files: int | None = None, world: int = 1):
        self.spark, self.path, self.run_id = spark, path, run_id
        self.samples, self.world, self.files = samples, world, files
        self.cpus = spark.sparkContext.defaultParallelism
        self.rows: list[dict] = []

    def timed(self, stage: str, action: Callable[[], Any], shard: int = 0) -> Any:
        """Run an action and note its wall time; `action` must do the work, not plan it."""
        started = time.perf_counter()
        result = action()
        self.note(stage, time.perf_counter() - started, shard)
        return result

    def note(self, stage: str, seconds: float, shard: int = 0) -> None:
        self.rows.append({
            "run_id": self.run_id, "at": datetime.now(timezone.utc), "stage": stage, "cpus": self.cpus,
            "files": self.files, "world": self.world, "samples": self.samples, "shard": shard, "seconds": seconds,
        })

    def append(self) -> None:
        rows, self.rows = self.rows, []
        if rows:
            frame = self.spark.createDataFrame(pa.Table.from_pylist(rows, _ARROW))
            frame.coalesce(1).write.mode("append").parquet(self.path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_METRICS).parquet(path)


def max_wall_time(metrics: DataFrame) -> DataFrame:
    """A stage's time is that of its slowest shard."""
    return metrics.groupBy("run_id", "stage").agg(F.max("seconds").alias("seconds"))

