from collections import defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusloom.session import scratch_path
from corpusloom.streaming.running import RunningCounts, append_running

ROW = "split string, shard int, pred int, label int, at timestamp"
START = 1_000_000_000


def place(row):
    """Sorts rows of null shards before others."""
    return row[0], row[1] is not None, row[1] or 0, row[2]


def rows(spark, data):
    frame = spark.createDataFrame(data, "split string, shard int, pred int, label int, s bigint")
    return frame.withColumn("at", F.timestamp_seconds("s")).drop("s")


def arrive(spark, root, data, every):
    rows(spark, data).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(ROW).parquet(f"{root}/in")
    append_running(stream, f"{root}/out", f"{root}/checkpoint", "20 seconds", every).awaitTermination()
    return sorted((tuple(r) for r in spark.read.parquet(f"{root}/out").collect()), key=place)


def wanted(data, every):
    counts = defaultdict(lambda: [0, 0])
    for split, shard, pred, label, s in data:
        at = counts[split, shard, s // every * every]
        at[0] += pred is not None and pred == label
        at[1] += 1
    out, sums = [], defaultdict(lambda: [0, 0])
    for (split, shard, window), (correct, total) in sorted(counts.items(), key=lambda kv: place(kv[0])):
        seen = sums[split, shard]
        seen[0] += correct
        seen[1] += total
        out.append((split, shard, window, correct, total, *seen))
    return out


@pytest.mark.parametrize("every", [1, 5])
def test_late_rows_count_in_time_order_and_only_once(spark, every):
    """Three runs of one checkpoint: rows in time, rows late but not too late, rows too late."""
    root = scratch_path(spark, "running")
    first = [("train", k % 2, k % 3 % 2, k % 2, START + k) for k in range(30)]
    first += [("test", None, None, 1, START + 12), ("test", None, 1, 1, START + 13)]
    late = [("train", k % 2, 1, 1, START + k) for k in range(14, 24)] * 2
    too_late = [("train", 0, 1, 1, START + 2), ("test", None, 1, 1, START - 50)]
    mark = [("", -1, None, None, START + 1000)]
    closed = arrive(spark, root, first, every)
    # The watermark is at the 9th second: only what ended by then is out.
    assert closed == [r for r in wanted(first, every) if r[2] + every <= START + 9]
    assert arrive(spark, root, late + too_late, every) == closed
    final = wanted(first + late, every)
    assert arrive(spark, root, mark, every) == final
    # A run without new rows adds nothing.
    stream = spark.readStream.schema(ROW).parquet(f"{root}/in")
    append_running(stream, f"{root}/out", f"{root}/checkpoint", "20 seconds", every).awaitTermination()
    assert spark.read.parquet(f"{root}/out").count() == len(final)


class Store:
    """State and timers of one key, counting the calls."""

    def __init__(self):
        self.calls, self.data, self.value, self.timers = 0, {}, None, set()

    def getMapState(self, *schema):
        return self

    def getValueState(self, *schema):
        return self

    def __getattribute__(self, name):
        if name in ("keys", "iterator", "containsKey", "getValue", "updateValue", "removeKey", "registerTimer"):
            self.calls += 1
        return object.__getattribute__(self, name)

    def keys(self):
        return iter([at for at in self.data])

    def iterator(self):
        self.calls += len(self.data)
        return iter(list(self.data.items()))

    def containsKey(self, at):
        return at in self.data

    def getValue(self, at):
        return self.data[at]

    def updateValue(self, at, value):
        self.data[at] = value

    def removeKey(self, at):
        del self.data[at]

    def registerTimer(self, at):
        self.timers.add(at)

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_many_windows_take_few_calls_to_the_state():
    """Windows that come in two runs and close in two: calls do not follow their number."""
    from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

    state, windows, every = Store(), 5000, 2
    counts = RunningCounts(every)
    counts.init(state)
    for late in (0, 1):
        window = [START + every * k for k in range(late, windows, 2)] * 2
        frame = pd.DataFrame({"window": window, "correct": 1, "total": 2})
        list(counts.handleInputRows(("train", 0), iter([frame[:1700], frame[1700:]]), None))
    found = []
    for last in (START + 2 * 1500 + 1, START + 10**6):
        now = last * 1000
        while due := sorted(t for t in state.timers if t <= now):
            state.timers -= {due[0]}
            times = TimerValues(0, now), ExpiredTimerInfo(due[0])
            found += [tuple(r) for f in counts.handleExpiredTimer(("train", 0), *times) for r in f.to_numpy()]
        assert len(found) in (1500, windows)
    assert found == [("train", 0, START + every * k, 2, 4, 2 * k + 2, 4 * k + 4) for k in range(windows)]
    assert not state.data and state.calls < 100
