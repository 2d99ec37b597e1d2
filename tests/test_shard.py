import pytest
from pyspark.sql import functions as F

from corpusloom.operators import batch, shard

CASES = [
    (16, 1, [16], [16]),
    (16, 4, [4, 4, 4, 4], [4, 4, 4, 4]),
    (16, 6, [2] * 6, [2, 2, 2, 2, 2, 6]),
    (16, 8, [2] * 8, [2] * 8),
    (2, 4, [1, 1, 0, 0], [0, 0, 0, 2]),
]


def file_table(spark, files, rows=3):
    return spark.createDataFrame(
        [("train", f"part-{i:05d}", rows) for i in range(files)], "split string, file string, file_rows bigint"
    )


@pytest.mark.parametrize("files,world,dropped,kept", CASES)
@pytest.mark.parametrize("policy", [shard.DROP_REMAINDER, shard.LAST_TAKES_REST])
def test_files_per_rank(spark, files, world, dropped, kept, policy):
    want = dropped if policy == shard.DROP_REMAINDER else kept
    assert [len(shard.file_positions(files, r, world, policy)) for r in range(world)] == want
    layout = shard.shard_layout(file_table(spark, files), world, policy)
    for rank in range(world):
        got = sorted(r.file_position for r in layout.filter(F.col("shard") == rank).collect())
        assert got == shard.file_positions(files, rank, world, policy)


def test_unknown_policy():
    with pytest.raises(ValueError):
        shard.file_positions(4, 0, 2, "other")


def layout_of(spark, counts):
    """One file per shard."""
    table = spark.createDataFrame(
        [("train", f"f{i}", n) for i, n in enumerate(counts)], "split string, file string, file_rows bigint"
    )
    return shard.shard_layout(table, len(counts))


@pytest.mark.parametrize("rows,size,whole,with_last", [(2500, 16, 156, 157), (500, 16, 31, 32), (32, 16, 2, 2)])
def test_batch_counts(spark, rows, size, whole, with_last):
    layout = layout_of(spark, [rows])
    assert batch.batch_counts(layout, size).first().batches == whole
    assert batch.batch_counts(layout, size, drop_last=False).first().batches == with_last


def test_minimum_over_ranks(spark):
    layout = layout_of(spark, [n * 16 for n in (3, 3, 4, 4, 3, 3)])
    assert batch.min_batch_counts(layout, 16, 6).first().min_batches == 3


def test_a_rank_without_files_supplies_no_batch(spark):
    layout = shard.shard_layout(file_table(spark, 2, 64), 4)
    assert batch.min_batch_counts(layout, 16, 4).first().min_batches == 0


def numbered(spark, sizes):
    data = [("train", f"f{i}", i * 1000 + r) for i, n in enumerate(sizes) for r in range(n)]
    return spark.createDataFrame(data, "split string, file string, doc_id bigint")


@pytest.mark.parametrize("keep,sizes", [
    (batch.KEEP_ALL, {0: [4, 4, 3], 1: [4, 2]}),
    (batch.DROP_LAST, {0: [4, 4], 1: [4]}),
    (batch.MATCHED, {0: [4], 1: [4]}),
])
def test_batches(spark, keep, sizes):
    rows = numbered(spark, [11, 6])
    layout = shard.shard_layout(shard.count_file_rows(rows), 2)
    batched = batch.with_batches(rows, batch.batch_layout(layout, 4, 2, keep), 4)
    got = {}
    for r in batched.groupBy("shard", "batch_id").count().orderBy("shard", "batch_id").collect():
        got.setdefault(r.shard, []).append(r["count"])
    assert got == sizes


def test_batches_run_across_files(spark):
    rows = numbered(spark, [3, 5, 4])
    layout = batch.batch_layout(shard.shard_layout(shard.count_file_rows(rows), 1), 4, 1, batch.KEEP_ALL)
    batched = batch.with_batches(rows, layout, 4)
    assert sorted(r.row_in_shard for r in batched.collect()) == list(range(12))
    assert {r["count"] for r in batched.groupBy("batch_id").count().collect()} == {4}


def test_matched_batches_never_vanish(spark):
    layout = shard.shard_layout(file_table(spark, 2, 64), 3)
    with pytest.raises(ValueError, match="no whole batch"):
        batch.batch_layout(layout, 16, 3, batch.MATCHED)
    assert {r.batch_limit for r in batch.batch_layout(layout, 16, 3).collect()} == {None}


def test_unknown_batch_policy(spark):
    with pytest.raises(ValueError):
        batch.batch_layout(layout_of(spark, [4]), 4, 1, "other")
