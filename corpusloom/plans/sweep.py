"""A grid of runs, one recorded result each."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import product

from pyspark.sql import DataFrame, functions as F

from corpusloom.functions.head import Features
from corpusloom.plans.prepare import prepare
from corpusloom.plans.runs import RunLog
from corpusloom.operators.batch import batch_layout, with_batches
from corpusloom.operators.shard import count_file_rows, shard_layout
from corpusloom.plans.train import fit, write_steps
from corpusloom.session import materialise, scratch_path
from corpusloom.sources import datasets


def sweep(
    labelled: DataFrame, root: str, metrics: str, samples: Iterable[int], files: Iterable[int],
    epochs: int = 10, dim: int = 256, lr: float = 0.05, vocab: DataFrame | None = None,
    steps_per_epoch: int = 1, batch_size: int = 16,
) -> None:
    """Prepare and train for every (files, samples) pair and append the stage times.

    `files` is the number of files a run writes and so its parallelism; the processors in
    use are recorded as they are.  All datasets together are one table under `root`,
    partitioned by run.  With several steps per epoch the batches are written by step.
    """
    spark = labelled.sparkSession
    for n_files, n_samples in product(files, samples):
        run_id = f"f{n_files}-s{n_samples}"
        log = RunLog(spark, metrics, run_id, samples=n_samples, files=n_files)
        path = log.timed("prepare", lambda: prepare(
            labelled, f"{root}/run_id={run_id}", n_files, vocab=vocab, samples=n_samples
        ))
        data = spark.read.parquet(path)
        if steps_per_epoch > 1:
            data = _by_step(spark, path, n_files, steps_per_epoch, batch_size)
        features = Features("input_ids", dim, hashed=True)
        log.timed("train", lambda: fit(data, features, epochs=epochs, lr=lr, steps_per_epoch=steps_per_epoch))
        log.append()


def _by_step(spark, path: str, files: int, steps: int, batch_size: int) -> DataFrame:
    scanned = datasets.scan(spark, path)
    layout = batch_layout(shard_layout(count_file_rows(scanned), 1), batch_size, 1)
    batched = with_batches(scanned, materialise(layout, "layout"), batch_size)
    return write_steps(batched, scratch_path(spark, "steps"), steps, files)


def recorded_runs(metrics: DataFrame) -> DataFrame:
    """Stages recorded per run, without the times."""
    return metrics.groupBy("run_id", "samples", "files").agg(
        F.count(F.lit(1)).alias("stages"), F.min((F.col("seconds") > 0).cast("int")).alias("timed")
    )
