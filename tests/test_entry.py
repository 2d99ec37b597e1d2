import duckdb
import pytest

import __spark_entry__ as entry
from corpusloom.plans import runs
from corpusloom.session import scratch_path
from corpusloom.sources import tables
from corpusloom.streaming import ingest
from corpusloom.plans.prepare import split_rows
from corpusloom.sources import store

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in ("documents", "labels", "embeddings", "benchmark", "conversations", "events"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.LLM_QUERIES)))
def test_query_matches_sql(spark, db, name):
    frame = entry.queries()[name](spark, FOLDER)
    columns = sorted(frame.columns)
    got = sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)
    if name not in entry.oracle_sql():
        assert got
        return
    want = db.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert got == sorted(want, key=repr)


def test_run_log(spark):
    path = scratch_path(spark, "metrics")
    for run, seconds in (("a", (1.0, 2.5)), ("b", (4.0,))):
        log = runs.RunLog(spark, path, run, samples=10, files=4, world=2)
        assert log.timed("prepare", lambda: 7) == 7
        for shard, s in enumerate(seconds):
            log.note("train", s, shard)
        log.append()
        log.append()
    metrics = runs.read_metrics(spark, path)
    assert metrics.count() == 5
    slowest = {(r.run_id, r.stage): r.seconds for r in runs.max_wall_time(metrics).collect()}
    assert slowest[("a", "train")] == 2.5 and slowest[("b", "train")] == 4.0
    assert {(r.cpus, r.files, r.world) for r in metrics.collect()} == {(spark.sparkContext.defaultParallelism, 4, 2)}


def test_arrivals_are_counted_once(spark):
    root = scratch_path(spark, "arrivals")
    labelled = tables.load_labelled(spark, FOLDER)
    even, odd = labelled.filter("doc_id % 2 = 0"), labelled.filter("doc_id % 2 = 1")
    for part in (even, odd):
        store.append(part, f"{root}/in")
        for _ in range(2):
            ingest.append_arrivals(
                ingest.read_arrivals(spark, f"{root}/in"), f"{root}/out", f"{root}/checkpoint"
            ).awaitTermination()
    want = split_rows(labelled)
    got = spark.read.parquet(f"{root}/out").select(*want.columns)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_a_repeated_batch_is_stored_once(spark):
    """A vocabulary over the bound: batches are joined to it, and replace themselves."""
    from corpusloom.catalog.queries import _vocab

    root = scratch_path(spark, "arrivals-joined")
    labelled = tables.load_labelled(spark, FOLDER)
    store.append(labelled, f"{root}/in")
    vocab = _vocab(spark, FOLDER)
    for checkpoint in ("a", "b"):  # a lost checkpoint repeats batch 0
        ingest.append_arrivals(
            ingest.read_arrivals(spark, f"{root}/in"), f"{root}/out", f"{root}/{checkpoint}", vocab, 32, max_tokens=0
        ).awaitTermination()
    got = spark.read.parquet(f"{root}/out")
    assert "input_ids" in got.columns and got.count() == split_rows(labelled).count()
