"""Epoch training of a linear head over frozen features."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusloom.functions.hashing import file_number
from corpusloom.functions.head import Features
from corpusloom.operators.gradient import evaluate_pass
from corpusloom.operators.optimizer import LEARNING_RATE, HeadState, adamw, initial_weights
from corpusloom.plans import state as saved
from corpusloom.schemas import EVAL_ACC, EVAL_LOSS, TRAIN, TRAIN_LOSS
from corpusloom.session import parallelism


def fit(
    data: DataFrame,
    features: Features,
    classes: int = 2,
    epochs: int = 3,
    lr: float = LEARNING_RATE,
    steps_per_epoch: int = 1,
    trainable: np.ndarray | None = None,
    weights: np.ndarray | None = None,
    run_id: str = "run",
    folder: str | None = None,
    save_every: int = 1,
) -> tuple[HeadState, list[tuple[int, str, float]]]:
    """Train to `epochs` epochs; returns the state and `(epoch, series, value)` rows.

    `data` has `split`, `label`, the feature column and, for several steps per epoch,
    `step`, from 0.  Pass a written table: for several steps one from `write_steps`,
    where a step reads only its own folder.

    A pass sums the training gradient and scores the test splits at the same weights.
    An epoch's test scores belong to the weights it ends with, which the next epoch's
    first pass reads anyway, so E epochs cost one pass over the test rows more than E
    gradient passes, not twice as many jobs.

    With `folder` the state is saved every `save_every` epochs and at the end, and a run
    that was saved before continues after its last saved epoch.
    """
    spark = data.sparkSession
    state, series, start = None, [], 0
    if folder:
        start = saved.latest_epoch(spark, folder, run_id) or 0
        if start:
            state, series = saved.load(spark, folder, run_id, start)
    if state is None:
        first = initial_weights(classes, features.dim) if weights is None else weights
        state = HeadState.fresh(first)

    is_train = F.col("split") == TRAIN
    scored = {e for e, name, _ in series if name in EVAL_LOSS.values()}

    def record_scores(epoch: int, metrics: dict) -> None:
        for split in EVAL_LOSS:
            if split in metrics:
                series.append((epoch, EVAL_LOSS[split], metrics[split][1]))
                series.append((epoch, EVAL_ACC[split], metrics[split][2]))
        scored.add(epoch)

    for epoch in range(start + 1, epochs + 1):
        losses = []
        for step in range(steps_per_epoch):
            rows = is_train
            if steps_per_epoch > 1:
                rows = rows & (F.col("step") == step)
            pending = step == 0 and epoch > 1 and epoch - 1 not in scored
            grad, metrics = evaluate_pass(
                data.filter(rows | ~is_train if pending else rows), features, state.weights
            )
            if pending:
                record_scores(epoch - 1, metrics)
            if grad is None:
                continue
            losses.append(metrics[TRAIN][1])
            state = adamw(state, grad, lr, trainable)
        if losses:
            series.append((epoch, TRAIN_LOSS, float(np.mean(losses))))
        if folder and epoch < epochs and epoch % save_every == 0:
            saved.save(spark, folder, run_id, epoch, state, series)

    if start < epochs:
        record_scores(epochs, evaluate_pass(data.filter(~is_train), features, state.weights)[1])
        if folder:
            saved.save(spark, folder, run_id, epochs, state, series)
    return state, sorted(series)


def write_steps(
    batched: DataFrame, path: str, steps: int, files: int | None = None, key: str = "doc_id"
) -> DataFrame:
    """Write batched rows under `split=/step=` folders and read them back.

    Step s has the batches with `batch_id % steps = s`, in `files` files: as many as the
    session's shuffles have partitions unless given, so no task writes a whole step.
    """
    files = files or parallelism(batched.sparkSession)
    rows = batched.withColumn("step", (F.col("batch_id") % steps).cast("int"))
    part = file_number(F.col(key), files)
    placed = rows.repartition("split", "step", part)
    placed.write.mode("overwrite").partitionBy("split", "step").parquet(path)
    return batched.sparkSession.read.schema(rows.schema).parquet(path)


def history_frame(spark, run_id: str, series: list[tuple[int, str, float]]) -> DataFrame:
    """History rows of a finished run; as many as epochs times series."""
    epochs, names, values = zip(*series) if series else ((), (), ())
    return spark.createDataFrame(pa.table({
        "run_id": pa.array([run_id] * len(series), pa.string()),
        "epoch": pa.array(epochs, pa.int32()),
        "series": pa.array(names, pa.string()),
        "value": pa.array(np.asarray(values, dtype=np.float64)),
    }))


def one_plain_step(data: DataFrame, features: Features, classes: int, lr: float) -> np.ndarray:
    """Weights after one plain gradient step from zero: a fixed head for scoring checks."""
    zero = np.zeros((classes, features.dim + 1))
    grad, _ = evaluate_pass(data.filter(F.col("split") == TRAIN), features, zero)
    return zero if grad is None else -lr * grad
