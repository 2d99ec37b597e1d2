import pytest
from pyspark.sql import functions as F

from corpusloom.functions.hashing import file_number
from corpusloom.operators import batch, shard, vocab as ov
from corpusloom.plans import prepare as pp
from corpusloom.session import materialise, scratch_path, shared_dir
from corpusloom.sources import datasets, store, tables

FILES = 4


@pytest.fixture(scope="module")
def labelled(spark):
    return tables.load_labelled(spark, "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def vocab(spark, labelled):
    from corpusloom.functions.clean import clean_and_filter

    return materialise(ov.build_vocab(clean_and_filter(labelled), 1000), "vocab")


@pytest.fixture(scope="module")
def dataset(spark, labelled, vocab):
    return pp.prepare(labelled, scratch_path(spark, "dataset"), FILES, vocab=vocab, max_length=16)


def test_every_row_is_written_once(spark, labelled, dataset):
    written = spark.read.parquet(dataset)
    want = pp.split_rows(labelled)
    assert sorted((r.doc_id, r.split, r.label) for r in written.collect()) == sorted(
        (r.doc_id, r.split, r.label) for r in want.collect()
    )
    assert {f.name: f.dataType.simpleString() for f in written.schema} == {
        "doc_id": "bigint", "label": "int", "input_ids": "array<int>", "attention_mask": "array<int>",
        "split": "string",
    }


def test_files_hold_their_rows_in_order(spark, dataset):
    """Physical places equal the places that plans without files compute."""
    scanned = datasets.scan(spark, dataset)
    layout = shard.shard_layout(shard.count_file_rows(scanned), 1)
    rows = scanned.join(layout.select("split", "file", "file_position"), ["split", "file"])
    rows = rows.withColumn("file_no", file_number(F.col("doc_id"), FILES))
    logical = batch.with_row_in_file(
        rows.drop("file", "row_in_file").withColumnRenamed("file_no", "file")
    ).withColumnRenamed("row_in_file", "logical_row")
    pairs = rows.join(logical.select("doc_id", "logical_row"), "doc_id")
    assert pairs.filter("file_no <> file_position or row_in_file <> logical_row").count() == 0


def test_scanned_batches_equal_planned_batches(spark, labelled, dataset):
    planned = pp.with_files(pp.split_rows(labelled).select("doc_id", "split", "label"), FILES)
    got = []
    for rows in (planned, datasets.scan(spark, dataset)):
        layout = batch.batch_layout(shard.shard_layout(shard.count_file_rows(rows), 2), 8, 2)
        batched = batch.with_batches(rows, materialise(layout, "layout"), 8)
        got.append(sorted((r.doc_id, r.shard, r.row_in_shard, r.batch_id) for r in batched.collect()))
    assert got[0] == got[1] and got[0]


@pytest.mark.parametrize("world", [1, 3, 4])
def test_ranks_read_their_own_files(spark, dataset, world):
    parts = [datasets.read_shard(spark, dataset, "train", r, world) for r in range(world)]
    keys = [r.doc_id for p in parts for r in p.collect()]
    want = spark.read.parquet(dataset).filter("split = 'train'")
    assert sorted(keys) == sorted(r.doc_id for r in want.collect())
    assert sum(len(p.inputFiles()) for p in parts) == len(datasets.sorted_files(spark, dataset, "train"))


def test_rank_without_files_reads_no_rows(spark, dataset):
    empty = datasets.read_shard(spark, dataset, "train", 0, 100)
    assert empty.count() == 0 and "input_ids" in empty.columns


def test_missing_split_is_an_error(spark, dataset):
    with pytest.raises(ValueError, match="no Parquet files"):
        datasets.sorted_files(spark, dataset, "absent")


def test_large_vocabulary_writes_the_same_dataset(spark, labelled, vocab, dataset, monkeypatch):
    import corpusloom.operators.encode as oe

    monkeypatch.setattr(pp, "broadcast_vocab", lambda v: None)
    monkeypatch.setattr(oe, "broadcast_vocab", lambda v, n: None)
    other = pp.prepare(labelled, scratch_path(spark, "joined"), FILES, vocab=vocab, max_length=16)
    a, b = spark.read.parquet(dataset), spark.read.parquet(other)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_reuse_needs_all_splits(spark, labelled, vocab):
    root = scratch_path(spark, "cache")
    first = pp.prepare_or_reuse(labelled, root, 2, vocab=vocab, max_length=16)
    assert pp.prepare_or_reuse(labelled, root, 2, vocab=vocab, max_length=16) == first

    partial = scratch_path(spark, "partial")
    datasets.record_manifest(spark, f"{partial}/manifest", "r", first, "as asked")
    manifest = datasets.read_manifest(spark, f"{partial}/manifest")
    assert datasets.find_cached(manifest, "as asked")["rows"] == spark.read.parquet(first).count()
    assert datasets.find_cached(manifest, "otherwise") is None
    assert datasets.find_cached(manifest.filter("split <> 'sst2'"), "as asked") is None


def test_reuse_needs_the_same_request(spark, labelled, vocab):
    root = scratch_path(spark, "requests")
    first = pp.prepare_or_reuse(labelled, root, 2, vocab=vocab, max_length=16, samples=20)
    others = [
        pp.prepare_or_reuse(labelled, root, 2, vocab=vocab, max_length=16),
        pp.prepare_or_reuse(labelled, root, 2, vocab=vocab, max_length=32, samples=20),
        pp.prepare_or_reuse(labelled.filter("doc_id > 5"), root, 2, vocab=vocab, max_length=16, samples=20),
        pp.prepare_or_reuse(labelled, root, 2, vocab=vocab.filter("id > 110"), max_length=16, samples=20),
    ]
    assert len({first, *others}) == 5
    assert pp.prepare_or_reuse(labelled, root, 2, vocab=vocab, max_length=16, samples=20) == first


def test_empty_split_is_complete(spark, labelled, vocab):
    root = scratch_path(spark, "one-domain")
    inner = tables.select_source(labelled, "IMDB")
    first = pp.prepare_or_reuse(inner, root, 2, vocab=vocab, max_length=16)
    assert pp.prepare_or_reuse(inner, root, 2, vocab=vocab, max_length=16) == first


def test_written_tables_are_deleted(spark):
    from corpusloom.session import path_exists, scratch

    with scratch(spark):
        path = materialise(spark.range(3), "gone").inputFiles()[0]
        assert path_exists(spark, path)
    assert not path_exists(spark, path)


def test_hot_texts_and_sources_leave_files_even(spark):
    """A third of the rows are copies of one text from one source, next to rare ones."""
    rows = [(i, "the same old text again" if i % 3 == 0 else f"text number {i}", 1, "SST-2" if i % 3 == 0 else "IMDB")
            for i in range(6000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, label int, source string")
    placed = datasets.arrange(pp.split_rows(frame), 8).select("doc_id", F.spark_partition_id().alias("p"))
    sizes = [r["count"] for r in placed.groupBy("p").count().collect()]
    assert sum(sizes) == 6000 and len(sizes) == 8 and max(sizes) < 1.2 * min(sizes)
    assert pp.capped_rows(frame, 1000).count() == 1000 + 200 + 200


def test_newest_complete_run_wins(spark):
    rows = [("old", s, f"/old/{s}", 1, 5) for s in ("train", "test", "sst2")]
    rows += [("new", s, f"/new/{s}", 2, 6) for s in ("train", "test", "sst2")]
    rows += [("cut", s, f"/cut/{s}", 3, 7) for s in ("train", "test")]
    frame = spark.createDataFrame(rows, "run_id string, split string, path string, t long, rows long")
    frame = frame.withColumn("created_at", F.timestamp_seconds("t")).withColumn("request", F.lit("q"))
    found = datasets.find_cached(frame, "q")
    assert (found["run_id"], found["train_path"], found["rows"]) == ("new", "/new/train", 18)


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc"])
def test_store_formats(spark, labelled, fmt):
    path = scratch_path(spark, f"store-{fmt}")
    store.append(labelled, path, fmt)
    store.append(labelled, path, fmt)
    back = store.read(spark, path, labelled.schema, fmt)
    twice = tables.stack(labelled, labelled)
    assert back.exceptAll(twice).count() == 0 and back.count() == twice.count()


def test_overwrite_named_replaces(spark, labelled):
    root = scratch_path(spark, "named")
    store.overwrite_named(labelled, root, "a")
    store.overwrite_named(labelled.limit(3), root, "a")
    assert store.read(spark, f"{root}/a").count() == 3


def test_corpus_reader(spark, labelled):
    root = scratch_path(spark, "corpus")
    raw = labelled.select("doc_id", F.col("text").alias("sentence"), F.col("label").cast("string").alias("y"))
    for part in ("a", "b"):
        raw.write.parquet(f"{root}/{part}")
    got = tables.read_corpus(spark, [f"{root}/a", f"{root}/b"], "SST-2", text_column="sentence", label_column="y")
    assert got.dtypes == labelled.dtypes and got.count() == 2 * labelled.count()
    # Keys are derived, and differ between the parts.
    assert got.select("doc_id").distinct().count() == got.count()
    with pytest.raises(ValueError, match="not unique"):
        tables.read_corpus(
            spark, [f"{root}/a", f"{root}/b"], "SST-2", text_column="sentence", label_column="y", key_column="doc_id"
        )
    one = tables.read_corpus(spark, [f"{root}/a"], "SST-2", "sentence", "doc_id", "y")
    assert sorted(r.doc_id for r in one.collect()) == sorted(r.doc_id for r in labelled.collect())
    assert {r.source for r in got.select("source").distinct().collect()} == {"SST-2"}


def test_corpus_reader_with_a_schema(spark, labelled):
    root = scratch_path(spark, "corpus-csv")
    labelled.select("doc_id", "label", F.lit("a, quoted text").alias("text")).write.option("header", True).csv(root)
    got = tables.read_corpus(
        spark, [root], "IMDB", fmt="csv", schema="doc_id bigint, label int, text string", header=True
    )
    assert got.count() == labelled.count() and got.first().text == "a, quoted text"
    assert got.select("doc_id").distinct().count() == got.count()


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_keyless_corpus_is_written_by_many_tasks(spark, monkeypatch):
    """The part with one file name in two folders is not drawn into one task."""
    from corpusloom.catalog import queries

    root = scratch_path(spark, "keyless-tables")
    spark.range(200).selectExpr(
        "id as doc_id", "concat('text ', id % 150) as text", "'en' as lang", "'s' as source", "9L as n_chars"
    ).write.parquet(f"{root}/documents.parquet")
    spark.range(200).selectExpr("id as doc_id", "cast(id % 2 as int) as quality", "0 as toxic").write.parquet(
        f"{root}/labels.parquet"
    )
    path = f"{root}/out"
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: path)
    found = queries.keyless_corpus(spark, root).collect()
    assert sum(r["keys"] for r in found) == 400 and len(found) == 150
    names = {label: {f.split("/")[-1] for f in spark.read.parquet(f"{path}/b/k={label}").inputFiles()} for label in (0, 1)}
    assert names[0] == names[1] and len(names[0]) > 1
