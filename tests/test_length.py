import hashlib

from pyspark.sql import functions as F

from corpusloom.operators.length import padding_share, read_by_length, write_by_length
from corpusloom.session import materialise, scratch_path

WIDTH = 32


def uniform(key):
    return int(hashlib.md5(f"42:{key}".encode()).hexdigest()[:8], 16) / 2**32


def encoded(spark, lengths):
    frame = spark.createDataFrame(list(lengths.items()), "doc_id bigint, n int").repartition(3)
    rows = frame.select(
        "doc_id", F.when(F.col("doc_id") % 4 == 0, "test").otherwise("train").alias("split"), F.lit(1).alias("label"),
        F.expr(f"transform(sequence(1, {WIDTH}), i -> if(i <= n, i, 0))").alias("input_ids"),
        F.expr(f"transform(sequence(1, {WIDTH}), i -> if(i <= n, 1, 0))").alias("attention_mask"),
    )
    return materialise(rows, "encoded")


def test_batches_by_length(spark):
    """A third of the rows have one length; rows are in order, whole, and cut to the batch's width."""
    lengths = {k: WIDTH if k % 3 == 0 else 2 + k * 7 % 29 for k in range(400)}
    path = scratch_path(spark, "by-length")
    write_by_length(encoded(spark, lengths), path, 4, 16)
    got = read_by_length(spark, path)
    for split in ("train", "test"):
        keys = sorted((k for k in lengths if (k % 4 == 0) == (split == "test")), key=lambda k: (lengths[k], uniform(k), k))
        rows = {r.doc_id: r for r in got.filter(F.col("split") == split).collect()}
        assert sorted(rows) == sorted(keys)
        for place, k in enumerate(keys):
            batch = keys[place // 16 * 16:place // 16 * 16 + 16]
            width = max(lengths[b] for b in batch)
            ids = [i if i <= lengths[k] else 0 for i in range(1, width + 1)]
            assert (rows[k].batch_id, rows[k].batch_row, rows[k].padded) == (place // 16, place % 16, width)
            assert list(rows[k].input_ids) == ids and rows[k].tokens == lengths[k]
        real, stored = sum(lengths[k] for k in keys), sum(r.padded for r in rows.values())
        share = padding_share(got).filter(F.col("split") == split).first()
        assert share.rows == len(keys) and abs(share.padding - (1 - real / stored)) < 1e-12
        assert stored < 0.9 * WIDTH * len(keys)


def test_a_range_of_lengths_reaches_the_scan(spark):
    path = scratch_path(spark, "by-length")
    write_by_length(encoded(spark, {k: 2 + k % 31 for k in range(300)}), path, 4, 8)
    some = read_by_length(spark, path, 5, 9)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(padded,5)" in plan and "LessThanOrEqual(padded,9)" in plan
    everything = read_by_length(spark, path)
    assert some.count() == everything.filter("padded between 5 and 9").count() > 0
    # Files follow the lengths: few of them hold the wanted ones.
    holding = some.select(F.col("_metadata.file_path")).distinct().count()
    assert holding < everything.select(F.col("_metadata.file_path")).distinct().count()


def test_no_rows(spark):
    path = scratch_path(spark, "by-length")
    write_by_length(encoded(spark, {1: 3}).limit(0), path, 2, 8)
    schema = "doc_id bigint, padded int"
    assert spark.read.schema(schema).parquet(path).count() == 0
