"""Reports over metric histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from corpusloom.schemas import EVAL_LOSS, TRAIN_LOSS

CURVES = (TRAIN_LOSS, *EVAL_LOSS.values())


def wide_history(history: DataFrame) -> DataFrame:
    """One row per run and epoch, one column per series."""
    series = [*CURVES, *[s.replace("losses", "acc") for s in EVAL_LOSS.values()]]
    return history.groupBy("run_id", "epoch").pivot("series", series).agg(F.max("value"))


def loss_curves(wide: DataFrame, *keys: str) -> DataFrame:
    """The three loss series by epoch as `(epoch, series, value)`.

    A run without any train loss has no curves at all.  `wide` has a row per epoch.
    """
    of_run = Window.partitionBy(*(keys or [F.lit(0)]))
    trained = wide.withColumn("_trained", F.max(TRAIN_LOSS).over(of_run)).filter("_trained is not null")
    return trained.unpivot([*keys, "epoch"], list(CURVES), "series", "value").filter("value is not null")


def rounded_by_run(history: DataFrame, runs: list[str], places: int = 4) -> DataFrame:
    """Series of several runs side by side, rounded."""
    rounded = history.withColumn("value", F.round("value", places) + F.lit(0.0))
    return rounded.groupBy("epoch", "series").pivot("run_id", runs).agg(F.max("value"))
