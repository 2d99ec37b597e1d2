"""Accuracy so far over scored rows as they arrive, in time order whatever order they come in.

Each rank of each split has state of its own: counts of the time windows that are still
open, and sums of those that were closed.  A window is closed by a timer when the watermark
has passed its end, so state is bounded by the delay and not by the stream, and a result
never changes once it is out.  Rows behind the watermark are dropped by Spark.

Open windows are kept in blocks of many, and a rank waits for its earliest window alone: calls
to the state store are few for each batch of rows, however many windows it opens or closes.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

RUNNING = "split string, shard int, window bigint, correct bigint, total bigint, seen_correct bigint, seen bigint"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# Windows whose counts are one entry of the state, and counts gathered before they are stored.
BLOCK_WINDOWS = 1024
HELD_COUNTS = 1_000_000


def add_counts(parts: list[np.ndarray]) -> np.ndarray:
    """Sums per window, in time order, of (window, correct, total) columns."""
    joined = np.concatenate(parts, axis=1)
    windows, where = np.unique(joined[0], return_inverse=True)
    sums = np.zeros((3, len(windows)), np.int64)
    sums[0] = windows
    np.add.at(sums[1], where, joined[1])
    np.add.at(sums[2], where, joined[2])
    return sums


class RunningCounts(StatefulProcessor):
    """Counts per window of `every` seconds, and their sums up to it, for one (split, shard)."""

    def __init__(self, every: int):
        self.every = every

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState(
            "open", "block bigint", "windows array<bigint>, correct array<bigint>, total array<bigint>"
        )
        self.closed = handle.getValueState("closed", "correct bigint, total bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for frame in rows:
            known = frame[["window", "correct", "total"]].dropna(subset=["window"])
            part = add_counts([known.to_numpy(np.int64).T])
            held.append(part)
            size += part.shape[1]
            if size >= HELD_COUNTS:
                self.store(add_counts(held))
                held, size = [], 0
        if size:
            self.store(add_counts(held))
        return iter(())

    def wait_for(self, window: int) -> None:
        self.handle.registerTimer((int(window) + self.every) * 1000)

    def store(self, counts: np.ndarray) -> None:
        """Add counts to their blocks.  A timer is due by the end of the earliest open window."""
        self.wait_for(counts[0, 0])
        block = counts[0] // (self.every * BLOCK_WINDOWS)
        for part in np.split(counts, np.flatnonzero(np.diff(block)) + 1, axis=1):
            at = (int(part[0, 0] // (self.every * BLOCK_WINDOWS)),)
            if self.open.containsKey(at):
                part = add_counts([np.array(list(self.open.getValue(at)), np.int64), part])
            self.open.updateValue(at, tuple(part.tolist()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Close every window that the watermark has passed, in order, and wait for the next."""
        last = timerValues.getCurrentWatermarkInMs() // 1000 - self.every
        sums = self.closed.get() if self.closed.exists() else (0, 0)
        for block in sorted(at for (at,) in self.open.keys()):
            counts = np.array(list(self.open.getValue((block,))), np.int64)
            due = int(np.searchsorted(counts[0], last, side="right"))
            if due:
                windows, correct, total = counts[:, :due]
                seen_correct, seen = np.cumsum(correct) + sums[0], np.cumsum(total) + sums[1]
                sums = (int(seen_correct[-1]), int(seen[-1]))
                self.closed.update(sums)
                if due == counts.shape[1]:
                    self.open.removeKey((block,))
                else:
                    self.open.updateValue((block,), tuple(counts[:, due:].tolist()))
                out = pd.DataFrame({"split": key[0], "shard": key[1], "window": windows})
                yield out.assign(correct=correct, total=total, seen_correct=seen_correct, seen=seen)
            if due < counts.shape[1]:
                self.wait_for(counts[0, due])
                break

    def close(self) -> None:
        pass


def running_accuracy(scored: DataFrame, delay: str, every: int = 1) -> DataFrame:
    """Counts of each closed window of `every` seconds of `at`, and their running sums.

    `scored` is a stream of `split`, `shard`, `pred`, `label` and its event time `at`; rows
    may come up to `delay` late.  A missing prediction or label counts as a row that is not correct.
    """
    hit = F.coalesce((F.col("pred") == F.col("label")).cast("long"), F.lit(0).cast("long"))
    start = (F.floor(F.unix_seconds("at") / every) * every).cast("long")
    rows = scored.withWatermark("at", delay).select(
        "split", "shard", "at", start.alias("window"), hit.alias("correct"), F.lit(1).cast("long").alias("total")
    )
    return rows.groupBy("split", "shard").transformWithStateInPandas(
        RunningCounts(every), outputStructType=RUNNING, outputMode="Append", timeMode="EventTime"
    )


@contextmanager
def _state_store(spark: SparkSession):
    """Keyed state with timers needs this store; a started query keeps it."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def append_running(scored: DataFrame, store: str, checkpoint: str, delay: str, every: int = 1) -> StreamingQuery:
    """Append closed windows to a Parquet store, each once, over any number of restarts."""
    with _state_store(scored.sparkSession):
        return (
            running_accuracy(scored, delay, every).writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(store)
        )
