"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Rows handed to Python at once; texts of 2 KB make 4 MB.
BATCH_ROWS = 2_000


def build_session(app: str = "corpusloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators assume; `conf` keys use `__` for `.`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, from `spark.checkpoint.dir`.

    Only a local master may fall back to a temporary folder, since there the driver
    and the tasks share one disk.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="corpusloom-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return os.path.join(shared_dir(spark), "corpusloom", f"{name}-{uuid.uuid4().hex}")


class _Tables(threading.local):
    """Intermediate tables of this thread that were not deleted yet.

    A stream's batches run in a thread of their own: what they release is theirs alone.
    """

    def __init__(self):
        self.paths: list[str] = []


_written = _Tables()


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: computed once, short lineage.

    The table stays until `release`, since lazy frames read it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    _written.paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    """The shuffle parallelism the session was sized for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Have the session hand Python at most `rows` rows at once, so that both sides hold less.

    A smaller setting stays.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > rows:
        spark.conf.set(name, str(rows))


def _file_system(spark: SparkSession, path: str):
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme and without a slash at its end, as Spark names files under it."""
    files, location = _file_system(spark, path)
    return files.makeQualified(location).toUri().toString().rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    files, location = _file_system(spark, path)
    return files.exists(location)


def list_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a pattern of the file system."""
    files, location = _file_system(spark, pattern)
    return [f.getPath().toString() for f in files.globStatus(location) or [] if f.isDirectory()]


def delete_path(spark: SparkSession, path: str) -> None:
    files, location = _file_system(spark, path)
    files.delete(location, True)


def release(spark: SparkSession) -> int:
    """Delete the intermediate tables written so far; frames that read them are then void.

    Call it when the results have been written.  `scratch` does so for a block.
    """
    count = len(_written.paths)
    while _written.paths:
        delete_path(spark, _written.paths.pop())
    return count


@contextmanager
def scratch(spark: SparkSession, keep: bool = False):
    """A block whose intermediate tables are deleted at its end.

    With `keep` the block gets a function like `materialise` whose tables outlive it: what
    they were made from is deleted once they are written.
    """
    before, _written.paths = _written.paths, []
    kept: list[str] = []

    def keeping(df: DataFrame, name: str) -> DataFrame:
        table = materialise(df, name)
        kept.append(_written.paths.pop())
        return table

    try:
        yield keeping if keep else None
    finally:
        release(spark)
        _written.paths = before + kept


def path_bytes(spark: SparkSession, path: str) -> int:
    """Stored size of a file or folder, from the file system alone."""
    files, location = _file_system(spark, path)
    return files.getContentSummary(location).getLength()
