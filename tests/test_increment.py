import os

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.clean import clean_and_filter
from corpusloom.functions.hashing import file_number
from corpusloom.operators import vocab as ov
from corpusloom.plans import increment, prepare as pp
from corpusloom.session import materialise, scratch_path
from corpusloom.sources import tables

BUCKETS, LENGTH = 8, 16


@pytest.fixture(scope="module")
def labelled(spark):
    return tables.load_labelled(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def vocab(spark, labelled):
    return materialise(ov.build_vocab(clean_and_filter(labelled), 500), "vocab")


def files(root):
    data = os.path.join(root.removeprefix("file:"), "data")
    return {os.path.join(at, f) for at, _, names in os.walk(data) for f in names if f.endswith(".parquet")}


def rows(frame):
    return sorted((r.doc_id, r.split, r.label, tuple(r.input_ids), tuple(r.attention_mask)) for r in frame.collect())


def full(spark, labelled, vocab):
    path = pp.prepare(labelled, scratch_path(spark, "full"), BUCKETS, vocab=vocab, max_length=LENGTH)
    return rows(spark.read.parquet(path))


def run(labelled, root, vocab, length=LENGTH):
    return increment.prepare_increment(labelled, root, BUCKETS, vocab, length)


def test_changed_added_and_removed_rows(spark, labelled, vocab):
    root = scratch_path(spark, "increment")
    assert run(labelled, root, vocab) == BUCKETS
    assert rows(increment.read_increment(spark, root)) == full(spark, labelled, vocab)
    before = files(root)
    placed = labelled.withColumn("b", file_number(F.col("doc_id"), BUCKETS))
    key = {b: placed.filter(F.col("b") == b).agg(F.min("doc_id")).first()[0] for b in (1, 4)}
    now = labelled.filter(F.col("doc_id") != key[1]).withColumn(
        "text", F.when(F.col("doc_id") == key[4], F.lit("other text of this row")).otherwise(F.col("text"))
    )
    new = spark.createDataFrame([(10**12, "a row that was not there", 1, "SST-2")], labelled.schema)
    now = now.unionByName(new)
    touched = {1, 4} | {r.b for r in new.select(file_number(F.col("doc_id"), BUCKETS).alias("b")).collect()}
    assert run(now, root, vocab) == len(touched)
    assert before < files(root)
    found = increment.read_increment(spark, root)
    assert rows(found) == full(spark, now, vocab)
    assert {r.bucket for r in found.filter("run = 2").collect()} == touched
    # Nothing changed, whatever the order of the rows.
    written = files(root)
    assert run(now.orderBy(F.desc("text")), root, vocab) == 0 and files(root) == written
    assert increment.drop_replaced(spark, root) == len(touched) + 1
    assert rows(increment.read_increment(spark, root)) == full(spark, now, vocab)
    assert run(now, root, vocab) == 0


def test_an_emptied_bucket_goes(spark, labelled, vocab):
    root = scratch_path(spark, "emptied")
    run(labelled, root, vocab)
    rest = labelled.filter(file_number(F.col("doc_id"), BUCKETS) != 3)
    assert run(rest, root, vocab) == 0
    assert rows(increment.read_increment(spark, root)) == full(spark, rest, vocab)


def test_no_rows_before_or_after(spark, labelled, vocab):
    root = scratch_path(spark, "none")
    assert run(labelled.limit(0), root, vocab) == 0 and increment.read_increment(spark, root).count() == 0
    assert run(labelled, root, vocab) == BUCKETS
    assert run(labelled.limit(0), root, vocab) == 0 and increment.read_increment(spark, root).count() == 0


def test_another_request_prepares_all(spark, labelled, vocab):
    root = scratch_path(spark, "request")
    run(labelled, root, vocab)
    assert run(labelled, root, vocab, length=8) == BUCKETS
    assert increment.read_increment(spark, root).select(F.max(F.size("input_ids"))).first()[0] == 8


def test_a_lost_run_is_not_seen(spark, labelled, vocab, monkeypatch):
    """Files without a manifest do not count, and the next run replaces them."""
    root = scratch_path(spark, "lost")
    run(labelled.filter("doc_id > 20"), root, vocab)
    want = rows(increment.read_increment(spark, root))
    encode = increment.encode_arranged
    monkeypatch.setattr(increment, "encode_arranged", lambda *a: encode(*a).withColumn(
        "label", F.when(F.col("doc_id") < 10, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("label"))
    ))
    with pytest.raises(Exception, match="lost"):
        run(labelled, root, vocab)
    monkeypatch.undo()
    assert rows(increment.read_increment(spark, root)) == want
    assert run(labelled, root, vocab) > 0
    assert rows(increment.read_increment(spark, root)) == full(spark, labelled, vocab)
