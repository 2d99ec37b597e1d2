import hashlib

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.split import even_partitions, sample_cap, seeded_shuffle, with_split
from corpusloom.plans.prepare import capped_rows, split_rows
from corpusloom.sources import tables


def uniform(key, word=0):
    return int(hashlib.md5(f"42:{key}".encode()).hexdigest()[8 * word:8 * word + 8], 16) / 2**32


def rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


@pytest.fixture
def labelled(spark, folder):
    return tables.load_labelled(spark, folder)


def test_one_scan_equals_union_of_loaders(spark, folder, labelled):
    union = tables.stack(tables.load_in_domain(spark, folder), tables.load_out_domain(spark, folder))
    assert labelled.schema == union.schema
    assert labelled.exceptAll(union).count() == 0 and union.exceptAll(labelled).count() == 0


def test_union_keeps_duplicates(labelled):
    assert tables.stack(labelled, labelled).count() == 2 * labelled.count()


def test_each_row_is_in_the_split_of_its_key(labelled):
    for key, source, split in rows(with_split(labelled), "doc_id", "source", "split"):
        want = "sst2" if source == "SST-2" else "train" if uniform(key) < 0.8 else "test"
        assert split == want


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_results_do_not_depend_on_partitions(labelled, partitions):
    moved = labelled.repartition(partitions)
    assert rows(with_split(moved), "doc_id", "split") == rows(with_split(labelled), "doc_id", "split")
    split = with_split(moved)
    assert rows(sample_cap(split, 20), "doc_id") == rows(sample_cap(with_split(labelled), 20), "doc_id")


@pytest.mark.parametrize("buckets", [1, 7, 512])
def test_shuffle_order(labelled, buckets):
    got = {r.doc_id: r.row_index for r in seeded_shuffle(labelled.select("doc_id"), buckets=buckets).collect()}
    want = sorted(got, key=lambda k: (uniform(k), k))
    assert [got[k] for k in want] == list(range(len(want)))


@pytest.mark.parametrize("cap", [1, 7, 30, 10_000])
def test_cap_is_the_head_of_each_split(labelled, cap):
    everything = rows(split_rows(labelled), "split", "doc_id")
    want = []
    for split in ("train", "test", "sst2"):
        keys = sorted((k for s, k in everything if s == split), key=lambda k: (uniform(k), k))
        want += [(split, k) for k in keys[:cap if split == "train" else int(cap * 0.2)]]
    assert rows(capped_rows(labelled, cap), "split", "doc_id") == sorted(want)


def test_no_cap_keeps_all(labelled):
    assert capped_rows(labelled, None).count() == split_rows(labelled).count() == capped_rows(labelled, 0).count()


def test_cap_falls_back_when_short_texts_fill_the_leading_rows(spark):
    ordered = sorted(range(4000), key=uniform)
    short = set(ordered[:1500])
    data = [(k, "too short" if k in short else "long enough a text", k % 2, "IMDB") for k in range(4000)]
    frame = spark.createDataFrame(data, "doc_id bigint, text string, label int, source string")
    train = [k for k in ordered if k not in short and uniform(k) < 0.8]
    got = [r.doc_id for r in capped_rows(frame, 100).filter("split = 'train'").collect()]
    assert sorted(got) == sorted(train[:100])


def test_even_partitions(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id")
    placed = even_partitions(documents, 5).select("doc_id", F.spark_partition_id().alias("p"))
    assert all(int(uniform(k, 1) * 5) == p for k, p in rows(placed, "doc_id", "p"))
    assert placed.count() == documents.count()
