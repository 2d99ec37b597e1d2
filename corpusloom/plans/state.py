"""Saved head state and metric histories, by run and epoch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.operators.optimizer import HeadState
from corpusloom.schemas import HISTORY, OPTIMIZER_STATE, WEIGHTS
from corpusloom.session import path_exists

_SCHEMAS = {"weights": WEIGHTS, "optimizer_state": OPTIMIZER_STATE, "history": HISTORY}


def _write(spark: SparkSession, folder: str, table: str, run_id: str, epoch: int, rows: pa.Table) -> None:
    # One folder per run and epoch, replaced as a whole: saving an epoch again after a
    # driver failure leaves no duplicate rows.
    path = f"{folder}/{table}/run_id={run_id}/epoch={epoch}"
    spark.createDataFrame(rows).coalesce(1).write.mode("overwrite").parquet(path)


def save(
    spark: SparkSession, folder: str, run_id: str, epoch: int, state: HeadState,
    series: list[tuple[int, str, float]],
) -> None:
    """Save the state after `epoch` epochs with all of the run's histories so far."""
    k, j = (axis.ravel().astype(np.int32) for axis in np.indices(state.weights.shape))
    steps = np.full(k.shape, state.step, dtype=np.int64)
    moments = {"k": k, "j": j, "m": state.m.ravel(), "v": state.v.ravel(), "step": steps}
    epochs, names, values = zip(*series) if series else ((), (), ())
    history = pa.table({
        "series": pa.array(names, pa.string()),
        "of_epoch": pa.array(epochs, pa.int32()),
        "value": pa.array(np.asarray(values, dtype=np.float64)),
    })
    _write(spark, folder, "history", run_id, epoch, history)
    _write(spark, folder, "optimizer_state", run_id, epoch, pa.table(moments))
    # Last, since a saved epoch counts as whole once its weights are there.
    _write(spark, folder, "weights", run_id, epoch, pa.table({"k": k, "j": j, "w": state.weights.ravel()}))


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """All saved rows of `weights`, `optimizer_state` or `history`."""
    schema = _SCHEMAS[table]
    if table == "history":
        schema = "run_id string, epoch int, series string, of_epoch int, value double"
    columns = [c.split()[0] for c in schema.split(", ")]
    return spark.read.schema(schema).parquet(f"{folder}/{table}").select(*columns)


def history(spark: SparkSession, folder: str, run_id: str) -> DataFrame:
    """The run's histories as last saved: `(run_id, epoch, series, value)`."""
    saved = read(spark, folder, "history").filter(F.col("run_id") == run_id)
    last = saved.agg(F.max("epoch").alias("epoch"))
    return saved.join(last, "epoch").select("run_id", F.col("of_epoch").alias("epoch"), "series", "value")


def latest_epoch(spark: SparkSession, folder: str, run_id: str) -> int | None:
    if not path_exists(spark, f"{folder}/weights"):
        return None
    return read(spark, folder, "weights").filter(F.col("run_id") == run_id).agg(F.max("epoch")).first()[0]


def load(spark: SparkSession, folder: str, run_id: str, epoch: int) -> tuple[HeadState, list]:
    """The state after `epoch` epochs and every series saved with it."""
    here = (F.col("run_id") == run_id) & (F.col("epoch") == epoch)
    cells = (
        read(spark, folder, "weights").filter(here).select("k", "j", "w")
        .join(read(spark, folder, "optimizer_state").filter(here).drop("run_id", "epoch"), ["k", "j"])
        .collect()
    )
    shape = (max(c.k for c in cells) + 1, max(c.j for c in cells) + 1)
    state = HeadState.fresh(np.zeros(shape))
    for c in cells:
        state.weights[c.k, c.j], state.m[c.k, c.j], state.v[c.k, c.j] = c.w, c.m, c.v
        state.step = c.step
    rows = read(spark, folder, "history").filter(here).select("of_epoch", "series", "value").collect()
    return state, [tuple(r) for r in rows]


def latest_path(states: DataFrame) -> DataFrame:
    """Per run, the path of the newest saved state; the later path on equal times."""
    newest = F.max_by("path", F.struct("created_at", "path"))
    return states.groupBy("run_id").agg(newest.alias("path"), F.max("created_at").alias("created_at"))
