"""Training with one update per global batch: an epoch is one job.

The ranks' batches of one number make a global batch.  Each task of a barrier stage holds
whole shards, in order of their batches, and a replica of the head.  After each batch the
tasks exchange the sums of their shards and all make the same update, so a step costs one
exchange instead of a Spark job, and only the epoch's end comes back to the driver.

Sums are kept per shard and added in shard order: weights do not depend on the number of
tasks, not even in their last bits.  A stage that loses an executor starts its epoch
again from the epoch's first weights.  An exchange moves a shard's K x (D + 1) numbers,
zeros left out, through the driver: it is meant for heads of thousands of weights, and
for as many tasks as run at once.  Spark looks once a second whether an exchange is over,
so a step takes a second at least, whatever the number of tasks; `fit` with a few steps an
epoch starts a job for each, which is quicker where few tasks are scheduled.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame, functions as F

from corpusloom.functions.head import Features
from corpusloom.operators.gradient import batch_gradient, evaluate_pass
from corpusloom.operators.optimizer import LEARNING_RATE, HeadState, adamw, initial_weights
from corpusloom.plans import state as saved
from corpusloom.schemas import EVAL_ACC, EVAL_LOSS, TRAIN, TRAIN_LOSS

_RESULT = "k int, j int, w double, m double, v double, step long, loss double"
# The sums of one shard's batch: rows, loss, gradient.
Sums = tuple[float, float, np.ndarray]


def pack(shard: int, sums: Sums) -> bytes:
    """One shard's sums as bytes, entries of the gradient that are zero left out."""
    rows, loss, gradient = sums
    flat = gradient.ravel()
    at = np.flatnonzero(flat)
    head = np.array([shard, rows, loss, len(at)], dtype=np.float64)
    return head.tobytes() + at.astype(np.int32).tobytes() + flat[at].tobytes()


def unpack(data: bytes, shape: tuple[int, int]) -> Iterator[tuple[int, Sums]]:
    place = 0
    while place < len(data):
        shard, rows, loss, count = np.frombuffer(data, np.float64, 4, place)
        place += 32
        at = np.frombuffer(data, np.int32, int(count), place)
        place += 4 * int(count)
        gradient = np.zeros(shape[0] * shape[1])
        gradient[at] = np.frombuffer(data[place : place + 8 * int(count)], np.float64)
        place += 8 * int(count)
        yield int(shard), (rows, loss, gradient.reshape(shape))


def _shard_batches(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[int, int, pa.Array, np.ndarray]]:
    """(step, shard, features, labels) of sorted rows; one shard's batch is held at once."""
    held: list[pa.RecordBatch] = []
    key = None

    def whole():
        table = pa.Table.from_batches(held).combine_chunks()
        return *key, table.column(column).combine_chunks(), table.column("label").to_numpy()

    for batch in batches:
        if not batch.num_rows:
            continue
        step, shard = (batch.column(c).to_numpy() for c in ("batch_id", "shard"))
        cuts = np.flatnonzero((np.diff(step) != 0) | (np.diff(shard) != 0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            own = (int(step[a]), int(shard[a]))
            if held and own != key:
                yield whole()
                held = []
            key = own
            held.append(batch.slice(a, b - a))
    if held:
        yield whole()


def _epoch(features: Features, first: HeadState, steps: int, lr: float, trainable: np.ndarray | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        state, losses = first, []
        own = _shard_batches(batches, features.column)
        waiting = next(own, None)
        for step in range(steps):
            message = b""
            while waiting is not None and waiting[0] == step:
                _, shard, column, label = waiting
                message += pack(shard, batch_gradient(features, column, label, state.weights))
                waiting = next(own, None)
            gathered = [base64.b64decode(m) for m in context.allGather(base64.b64encode(message).decode())]
            found = sorted((x for data in gathered for x in unpack(data, state.weights.shape)), key=lambda x: x[0])
            rows = sum(r for _, (r, _, _) in found)
            if rows:
                losses.append(sum(x for _, (_, x, _) in found) / rows)
                state = adamw(state, sum(g for _, (_, _, g) in found) / rows, lr, trainable)
        if context.partitionId() == 0:
            k, j = (axis.ravel().astype(np.int32) for axis in np.indices(state.weights.shape))
            loss = float(np.mean(losses)) if losses else None
            arrays = [k, j, state.weights.ravel(), state.m.ravel(), state.v.ravel(), np.full(k.shape, state.step)]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, arrays), pa.array([loss] * len(k), pa.float64())],
                ["k", "j", "w", "m", "v", "step", "loss"],
            )

    return run


def run_epoch(
    train: DataFrame, features: Features, state: HeadState, steps: int, tasks: int,
    lr: float = LEARNING_RATE, trainable: np.ndarray | None = None,
) -> tuple[HeadState, float | None]:
    """The state after `steps` updates and the mean of their losses; None without rows."""
    rows = train.select("shard", "batch_id", "row_in_shard", "label", features.column)
    placed = rows.repartitionById(tasks, F.pmod("shard", F.lit(tasks)).cast("int")).sortWithinPartitions(
        "batch_id", "shard", "row_in_shard"
    )
    narrow = placed.select("shard", "batch_id", "label", features.column)
    cells = narrow.mapInArrow(_epoch(features, state, steps, lr, trainable), _RESULT, barrier=True).collect()
    after = HeadState.fresh(np.zeros_like(state.weights))
    for c in cells:
        after.weights[c.k, c.j], after.m[c.k, c.j], after.v[c.k, c.j] = c.w, c.m, c.v
    after.step = cells[0].step
    return after, cells[0].loss


def fit_minibatches(
    data: DataFrame, features: Features, classes: int = 2, epochs: int = 3, lr: float = LEARNING_RATE,
    tasks: int | None = None, trainable: np.ndarray | None = None, weights: np.ndarray | None = None,
    run_id: str = "run", folder: str | None = None, save_every: int = 1,
) -> tuple[HeadState, list[tuple[int, str, float]]]:
    """`fit` with an update after every global batch; the same results and saved state.

    `data` is a written table with `split`, `shard`, `batch_id`, `row_in_shard`, `label`
    and the features, from `operators.batch.with_batches`.  The gradient of a batch is the
    mean over its rows of all shards; a shard that has run out of batches adds none.
    `tasks` run at once (by default as many as there are shards, at most the session's
    cores) and need as many free slots.  An epoch reads and sorts the training rows once.
    """
    spark = data.sparkSession
    train = data.filter(F.col("split") == TRAIN)
    extent = train.agg(F.max("batch_id").alias("last"), F.countDistinct("shard").alias("shards")).first()
    steps = 0 if extent.last is None else extent.last + 1
    tasks = tasks or max(1, min(extent.shards, spark.sparkContext.defaultParallelism))
    state, series, start = None, [], 0
    if folder:
        start = saved.latest_epoch(spark, folder, run_id) or 0
        if start:
            state, series = saved.load(spark, folder, run_id, start)
    if state is None:
        state = HeadState.fresh(initial_weights(classes, features.dim) if weights is None else weights)
    for epoch in range(start + 1, epochs + 1):
        if steps:
            state, loss = run_epoch(train, features, state, steps, tasks, lr, trainable)
            series.append((epoch, TRAIN_LOSS, loss))
        metrics = evaluate_pass(data.filter(F.col("split") != TRAIN), features, state.weights)[1]
        for split in EVAL_LOSS:
            if split in metrics:
                series += [(epoch, EVAL_LOSS[split], metrics[split][1]), (epoch, EVAL_ACC[split], metrics[split][2])]
        if folder and (epoch == epochs or epoch % save_every == 0):
            saved.save(spark, folder, run_id, epoch, state, series)
    return state, sorted(series)
