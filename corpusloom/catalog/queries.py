"""One query per operator over the given tables: `(spark, folder) -> DataFrame`."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.functions import clean as fc, encode as fe, wordpiece as fw
from corpusloom.functions.hashing import file_number, order_uniform
from corpusloom.functions.head import Features, with_scores
from corpusloom.operators import batch, encode as oe, evaluate, length, shard, split, vocab as ov
from corpusloom.operators.gradient import evaluate_pass, gradient
from corpusloom.operators.optimizer import HeadState, adamw, initial_weights
from corpusloom.plans import increment, prepare as pp, report, runs, state as saved, sweep as ps
from corpusloom.plans.minibatch import fit_minibatches
from corpusloom.plans.train import fit, history_frame, one_plain_step, write_steps
from corpusloom.schemas import IN_DOMAIN, LABELLED, OUT_DOMAIN, TRAIN
from corpusloom.session import materialise, scratch_path
from corpusloom.sources import datasets, store, tables
from corpusloom.streaming import ingest, running

FILES, WORLD, BATCH = 8, 3, 16
VOCAB, MAX_LENGTH, SHORT_LENGTH = 5000, 256, 32
PIECE_WORDS, PIECES = 500, 2000
CAP = 100
EMBEDDING = Features("embedding", 64)
HEAD_LR = 1.0
ADAM_LR = 0.05
SMALL_BATCH, STEPS, TEXT_DIM, TEXT_LR = 4, 2, 512, 0.01
MINI_STEPS = 3
SWEEP_SAMPLES, SWEEP_FILES, SWEEP_EPOCHS = (100, 200), (2, 4), 2
FROZEN = 32
FEW_FILES, REUSE_LENGTH = 2, 16
BUCKETS, ARRIVED = 64, 0.99
# The time of the first batch, and the seconds that a scored row may come late; a batch is a second.
EPOCH, LATEST = 10**9, 10**8


def _number(column, places: int = 6):
    # Adding zero turns a rounded -0.0 into 0.0.
    return F.round(column, places) + F.lit(0.0)


def _joined(column: str):
    return F.array_join(F.col(column).cast("array<string>"), ",")


# Loading and storing.

def load_in_domain(spark: SparkSession, folder: str) -> DataFrame:
    return tables.load_in_domain(spark, folder)


def load_out_domain(spark: SparkSession, folder: str) -> DataFrame:
    return tables.load_out_domain(spark, folder)


def concat_splits(spark: SparkSession, folder: str) -> DataFrame:
    """The in-domain corpus from two parts, as a corpus that comes in two splits."""
    documents = tables.read_table(spark, folder, "documents").filter("lang = 'en'").select("doc_id", "text")
    labels = tables.read_table(spark, folder, "labels").withColumnRenamed("quality", "label")
    parts = [documents.join(labels.filter(F.col("toxic") == t), "doc_id") for t in (0, 1)]
    return tables.typed(tables.tag(tables.stack(*parts), IN_DOMAIN))


def tag_and_union(spark: SparkSession, folder: str) -> DataFrame:
    return tables.stack(tables.load_in_domain(spark, folder), tables.load_out_domain(spark, folder))


def select_source(spark: SparkSession, folder: str) -> DataFrame:
    return tables.select_source(tables.load_labelled(spark, folder), OUT_DOMAIN)


def store_append_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "store")
    store.append(tables.load_in_domain(spark, folder), path)
    store.append(tables.load_out_domain(spark, folder), path)
    return store.read(spark, path, LABELLED)


def store_append_run(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs, the first of them repeated: the store keeps each row once per run."""
    path = scratch_path(spark, "runs")
    for run_id, load in (("in", tables.load_in_domain), ("in", tables.load_in_domain), ("out", tables.load_out_domain)):
        store.append_run(load(spark, folder), path, run_id)
    return store.read(spark, path)


def store_overwrite_named(spark: SparkSession, folder: str) -> DataFrame:
    root = scratch_path(spark, "named")
    rows = tables.load_labelled(spark, folder)
    store.overwrite_named(rows, root, "reviews", fmt="json")
    path = store.overwrite_named(fc.clean_and_filter(rows), root, "reviews", fmt="json")
    return store.read(spark, path, LABELLED, fmt="json")


def jsonl_sample(spark: SparkSession, folder: str) -> DataFrame:
    raw = tables.load_labelled(spark, folder)
    stages = {"raw": raw, "processed": fc.clean_and_filter(raw)}
    parts = []
    for stage, rows in stages.items():
        path = scratch_path(spark, f"sample-{stage}")
        store.export_json_sample(rows, path)
        parts.append(spark.read.schema(LABELLED).json(path).withColumn("stage", F.lit(stage)))
    return tables.stack(*parts)


def parquet_roundtrip_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and real tokens per split and file position, from a written dataset."""
    path = scratch_path(spark, "dataset")
    pp.prepare(tables.load_labelled(spark, folder), path, FILES, vocab=_vocab(spark, folder), max_length=MAX_LENGTH)
    scanned = datasets.scan(spark, path)
    placed = shard.with_shard(scanned, _layout(scanned))
    tokens = F.aggregate("attention_mask", F.lit(0).cast("long"), lambda a, m: a + m)
    return placed.groupBy("split", "file_position").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(tokens).alias("tokens"), F.sum("label").alias("positives")
    )


def prepare_reuse(spark: SparkSession, folder: str) -> DataFrame:
    """A capped, a full and a repeated full request: only the last finds its dataset."""
    root = scratch_path(spark, "reuse")
    labelled, vocab = tables.load_labelled(spark, folder), _vocab(spark, folder)
    requests = {
        "capped": {"samples": CAP, "max_length": REUSE_LENGTH}, "full": {"max_length": MAX_LENGTH},
        "again": {"max_length": MAX_LENGTH},
    }
    parts, paths = [], []
    for name, options in requests.items():
        path = pp.prepare_or_reuse(labelled, root, FILES, vocab=vocab, **options)
        counted = spark.read.parquet(path).groupBy("split").agg(
            F.count(F.lit(1)).alias("rows"), F.max(F.size("input_ids")).alias("length")
        )
        parts.append(counted.select(F.lit(name).alias("request"), F.lit(path in paths).alias("reused"), "*"))
        paths.append(path)
    return tables.stack(*parts)


def prepare_increment(spark: SparkSession, folder: str) -> DataFrame:
    """A dataset brought up to date when the last rows of the seeded order have arrived."""
    root = scratch_path(spark, "increment")
    labelled, vocab = tables.load_labelled(spark, folder), _vocab(spark, folder)
    for rows in (labelled.filter(order_uniform(F.col("doc_id")) < ARRIVED), labelled, labelled):
        increment.prepare_increment(rows, root, BUCKETS, vocab, MAX_LENGTH)
    found = increment.read_increment(spark, root)
    return found.select("doc_id", "split", "label", _joined("input_ids").alias("input_ids"), "bucket", "run")


def shard_rows_few_files(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that each rank reads when there are fewer files than ranks."""
    path = scratch_path(spark, "few-files")
    pp.prepare(tables.load_labelled(spark, folder), path, FEW_FILES, vocab=_vocab(spark, folder))
    parts = [
        datasets.read_shard(spark, path, TRAIN, rank, WORLD).agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(rank).alias("rank"), "rows")
        for rank in range(WORLD)
    ]
    return tables.stack(*parts)


def keyless_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Two parts without a key, the second a copy of the first: every row has its own."""
    path = scratch_path(spark, "keyless")
    rows = tables.load_in_domain(spark, folder).select(F.col("text").alias("sentence"), "label")
    rows.write.parquet(f"{path}/a")
    # A task's rows of both labels are one file name in two folders.
    rows.withColumn("k", F.col("label")).write.partitionBy("k").parquet(f"{path}/b")
    corpus = tables.read_corpus(spark, [f"{path}/a", f"{path}/b"], IN_DOMAIN, text_column="sentence")
    return corpus.groupBy("text", "label", "source").agg(F.countDistinct("doc_id").alias("keys"))


def manifest_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Complete datasets among one run per crawl source, by a manifest of their splits."""
    crawl = tables.read_table(spark, folder, "documents").select("doc_id", F.col("source").alias("run_id"))
    rows = split.with_split(tables.load_labelled(spark, folder).drop("text")).join(crawl, "doc_id")
    manifest = rows.groupBy("run_id", "split").agg(
        F.concat_ws("/", "run_id", "split").alias("path"),
        F.timestamp_seconds(F.max("doc_id")).alias("created_at"),
        F.count(F.lit(1)).alias("rows"),
    )
    found = datasets.complete_runs(manifest)
    return found.withColumn("created_at", F.unix_seconds("created_at"))


# Text.

def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    documents = tables.read_texts(spark, folder, "documents")
    benchmark = tables.read_table(spark, folder, "benchmark")
    talk = tables.read_texts(spark, folder, "conversations", "conv_id")
    no_turn = F.lit(0).cast("long")

    def texts(table: DataFrame, kind: str, key: str, turn) -> DataFrame:
        return table.select(F.lit(kind).alias("kind"), F.col(key).alias("id"), turn.alias("turn"), "text")

    return fc.with_clean_text(tables.stack(
        texts(documents, "documents", "doc_id", no_turn),
        texts(benchmark, "benchmark", "item_id", no_turn),
        texts(talk, "conversations", "conv_id", F.col("turn")),
    ))


def clean_text_edge(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with the benchmark text of the same number, mostly null."""
    documents = tables.read_table(spark, folder, "documents").select("doc_id")
    benchmark = tables.read_table(spark, folder, "benchmark").withColumnRenamed("item_id", "doc_id")
    cleaned = fc.with_clean_text(documents.join(benchmark, "doc_id", "left"))
    return cleaned.withColumn("chars", F.length("text"))


def strip_punct(spark: SparkSession, folder: str) -> DataFrame:
    return tables.read_texts(spark, folder, "documents").select("doc_id", fc.strip_marks(F.col("text")).alias("text"))


def min_length_clean(spark: SparkSession, folder: str) -> DataFrame:
    return fc.clean_and_filter(tables.read_texts(spark, folder, "documents").select("doc_id", "text"))


def min_length_raw(spark: SparkSession, folder: str) -> DataFrame:
    return fc.min_length(tables.read_table(spark, folder, "documents").select("doc_id", "text"))


# Vocabulary and encoding.

def _corpus(spark: SparkSession, folder: str) -> DataFrame:
    return fc.clean_and_filter(tables.read_texts(spark, folder, "documents").select("doc_id", "text"))


def _vocab(spark: SparkSession, folder: str) -> DataFrame:
    return materialise(ov.build_vocab(_corpus(spark, folder), VOCAB), "vocab")


def _piece_vocab(spark: SparkSession, folder: str) -> DataFrame:
    corpus = _corpus(spark, folder)
    return materialise(ov.build_piece_vocab(corpus, PIECE_WORDS, PIECES), "pieces")


def build_vocab(spark: SparkSession, folder: str) -> DataFrame:
    return ov.build_vocab(_corpus(spark, folder), VOCAB)


def build_piece_vocab(spark: SparkSession, folder: str) -> DataFrame:
    return ov.build_piece_vocab(_corpus(spark, folder), PIECE_WORDS, PIECES)


def encode_ids(spark: SparkSession, folder: str) -> DataFrame:
    encoded = oe.encode(_corpus(spark, folder), _vocab(spark, folder), MAX_LENGTH)
    return encoded.select("doc_id", _joined("encoding.input_ids").alias("input_ids"))


def encode_ids_join(spark: SparkSession, folder: str) -> DataFrame:
    """The form for vocabularies too large to broadcast, with few hot tokens."""
    encoded = oe.encode_by_join(_corpus(spark, folder), _vocab(spark, folder), MAX_LENGTH, hot_tokens=100, keep_text=False)
    return encoded.select("doc_id", _joined("encoding.input_ids").alias("input_ids"))


def encode_repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Two parts with the same keys and other texts, by both forms."""
    # Cleaned once: each form reads both parts, and the vocabulary one.
    corpus = materialise(_corpus(spark, folder), "corpus")
    other = corpus.select("doc_id", F.reverse(F.split("text", " ")).alias("words"))
    both = corpus.unionByName(other.select("doc_id", F.array_join("words", " ").alias("text")))
    vocab = materialise(ov.build_vocab(corpus, VOCAB), "vocab")
    forms = {"broadcast": oe.encode(both, vocab, MAX_LENGTH), "join": oe.encode_by_join(both, vocab, MAX_LENGTH, hot_tokens=100)}
    ids = _joined("encoding.input_ids").alias("input_ids")
    return tables.stack(*[f.select(F.lit(name).alias("form"), "doc_id", ids) for name, f in forms.items()])


def encode_truncation(spark: SparkSession, folder: str) -> DataFrame:
    encoded = oe.encode(_corpus(spark, folder), _vocab(spark, folder), SHORT_LENGTH)
    words = F.size(F.split("text", " "))
    return encoded.select(
        "doc_id", (words > SHORT_LENGTH - 2).cast("int").alias("truncated"),
        _joined("encoding.input_ids").alias("input_ids"),
    )


def attention_mask(spark: SparkSession, folder: str) -> DataFrame:
    encoded = oe.encode(_corpus(spark, folder), _vocab(spark, folder), MAX_LENGTH)
    return encoded.select("doc_id", _joined("encoding.attention_mask").alias("attention_mask"))


def encoded_projection(spark: SparkSession, folder: str) -> DataFrame:
    rows = fc.clean_and_filter(tables.load_labelled(spark, folder))
    encoded = oe.encoded_rows(oe.encode(rows, _vocab(spark, folder), MAX_LENGTH), "doc_id", "source")
    return encoded.withColumns({c: _joined(c) for c in ("input_ids", "attention_mask")})


def wordpiece_words(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of every distinct word."""
    words = ov.count_words(_corpus(spark, folder))
    shared = oe.broadcast_vocab(_piece_vocab(spark, folder))
    if shared is None:
        raise ValueError("the vocabulary is too large to show pieces by broadcast")
    pieces = fw.piece_splitter(shared)
    return words.select("token", "n", F.array_join(pieces(F.col("token")), " ").alias("pieces"))


def wordpiece_encode(spark: SparkSession, folder: str) -> DataFrame:
    encoded = oe.encode(_corpus(spark, folder), _piece_vocab(spark, folder), MAX_LENGTH, pieces=True)
    return encoded.select("doc_id", _joined("encoding.input_ids").alias("input_ids"))


def wordpiece_encode_join(spark: SparkSession, folder: str) -> DataFrame:
    """Word pieces for vocabularies too large to broadcast, with few hot tokens."""
    # Cleaned once, for the vocabulary and the rows.
    corpus = materialise(_corpus(spark, folder), "corpus")
    vocab = materialise(ov.build_piece_vocab(corpus, PIECE_WORDS, PIECES), "pieces")
    encoded = oe.encode_pieces_by_join(corpus, vocab, MAX_LENGTH, hot_tokens=100, keep_text=False)
    return encoded.select("doc_id", _joined("encoding.input_ids").alias("input_ids"))


# Order, splits, samples.

def _rows(spark: SparkSession, folder: str) -> DataFrame:
    return pp.split_rows(tables.load_labelled(spark, folder))


def seeded_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    rows = tables.read_table(spark, folder, "documents").select("doc_id")
    return split.seeded_shuffle(rows)


def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    u = _number(order_uniform(F.col("doc_id")), 9)
    return _rows(spark, folder).select("doc_id", "source", "split", u.alias("u"))


def split_counts(spark: SparkSession, folder: str) -> DataFrame:
    return pp.corpus_summary(_rows(spark, folder))


def sample_cap(spark: SparkSession, folder: str) -> DataFrame:
    capped = pp.capped_rows(tables.load_labelled(spark, folder), CAP)
    return capped.select("doc_id", "split", "label", "text")


def sample_cap_stratified(spark: SparkSession, folder: str) -> DataFrame:
    """The same cap with each split's share of labels."""
    capped = pp.capped_rows(tables.load_labelled(spark, folder), CAP, stratify="label")
    return capped.select("doc_id", "split", "label", "text")


def partition_balance(spark: SparkSession, folder: str) -> DataFrame:
    chars = F.length("text").cast("long")
    documents = tables.read_table(spark, folder, "documents").select("doc_id", chars.alias("chars"))
    placed = split.even_partitions(documents, FILES).groupBy(F.spark_partition_id().alias("part"))
    return placed.agg(F.count(F.lit(1)).alias("rows"), F.sum("chars").alias("chars"))


# Shards and batches.

def _filed(spark: SparkSession, folder: str) -> DataFrame:
    rows = split.with_split(tables.load_labelled(spark, folder)).select("doc_id", "split", "label")
    return pp.with_files(rows, FILES)


def _files(rows: DataFrame, policy: str = shard.LAST_TAKES_REST) -> DataFrame:
    return shard.shard_layout(shard.count_file_rows(rows), WORLD, policy)


def _layout(rows: DataFrame, policy: str = shard.LAST_TAKES_REST) -> DataFrame:
    return materialise(_files(rows, policy), "layout")


def shard_drop_remainder(spark: SparkSession, folder: str) -> DataFrame:
    rows = _filed(spark, folder)
    placed = shard.with_shard(rows, _layout(rows, shard.DROP_REMAINDER))
    return placed.select("doc_id", "split", "file_position", "shard")


def shard_last_takes_rest(spark: SparkSession, folder: str) -> DataFrame:
    rows = _filed(spark, folder)
    return shard.with_shard(rows, _layout(rows)).select("doc_id", "split", "file_position", "shard")


def _batched(rows: DataFrame, keep: str, size: int = BATCH) -> DataFrame:
    layout = materialise(batch.batch_layout(_files(rows), size, WORLD, keep, allow_none=True), "batches")
    return batch.with_batches(rows, layout, size)


_BATCHED = ("doc_id", "split", "shard", "row_in_shard", "batch_id")


def batch_drop_last(spark: SparkSession, folder: str) -> DataFrame:
    return _batched(_filed(spark, folder), batch.DROP_LAST).select(*_BATCHED)


def batch_keep_last(spark: SparkSession, folder: str) -> DataFrame:
    return _batched(_filed(spark, folder), batch.KEEP_ALL).select(*_BATCHED)


def batch_few_files(spark: SparkSession, folder: str) -> DataFrame:
    """Batches with fewer files than ranks: the default keeps every row."""
    rows = split.with_split(tables.load_labelled(spark, folder)).select("doc_id", "split", "label")
    placed = pp.with_files(rows, FEW_FILES)
    layout = materialise(batch.batch_layout(_files(placed), BATCH, WORLD), "batches")
    return batch.with_batches(placed, layout, BATCH).select(*_BATCHED)


def batches_per_shard(spark: SparkSession, folder: str) -> DataFrame:
    return batch.batch_counts(_files(_filed(spark, folder)), BATCH)


def min_batches(spark: SparkSession, folder: str) -> DataFrame:
    return batch.min_batch_counts(_files(_filed(spark, folder)), BATCH, WORLD)


def batch_truncate(spark: SparkSession, folder: str) -> DataFrame:
    return _batched(_filed(spark, folder), batch.MATCHED).select(*_BATCHED)


def batch_by_length(spark: SparkSession, folder: str) -> DataFrame:
    """A written dataset in batches of like length, read back."""
    path, out = scratch_path(spark, "dataset"), scratch_path(spark, "by-length")
    pp.prepare(tables.load_labelled(spark, folder), path, FILES, vocab=_vocab(spark, folder), max_length=MAX_LENGTH)
    length.write_by_length(spark.read.parquet(path), out, FILES, BATCH)
    rows = length.read_by_length(spark, out)
    return rows.select(
        "doc_id", "split", "label", "tokens", "batch_id", "batch_row", "padded", _joined("input_ids").alias("input_ids")
    )


# Training.

def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings as two-class rows: labels 0 to 7 in-domain, 8 and 9 out of domain."""
    rows = tables.read_table(spark, folder, "embeddings")
    source = F.when(F.col("label") < 8, IN_DOMAIN).otherwise(OUT_DOMAIN)
    return split.with_split(rows.select(
        F.col("vec_id").alias("doc_id"), "embedding", (F.col("label") % 2).alias("label"), source.alias("source")
    )).drop("source")


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _vectors(spark, folder)
    weights = one_plain_step(vectors, EMBEDDING, 2, HEAD_LR)
    return with_scores(vectors, EMBEDDING, weights).drop("embedding")


def _scored_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Scored where they are read, so that numbering moves no vectors."""
    return _batched(pp.with_files(_scored(spark, folder), FILES), batch.KEEP_ALL)


def head_init_loss(spark: SparkSession, folder: str) -> DataFrame:
    scored = with_scores(_vectors(spark, folder), EMBEDDING, initial_weights(2, EMBEDDING.dim))
    return scored.select("doc_id", "split", _number(F.col("loss")).alias("loss"))


def gradient_step(spark: SparkSession, folder: str) -> DataFrame:
    grad = gradient(_vectors(spark, folder), EMBEDDING, initial_weights(2, EMBEDDING.dim))
    return grad.select("k", "j", _number(F.col("gradient"), 9).alias("gradient"))


def adamw_step(spark: SparkSession, folder: str) -> DataFrame:
    state = HeadState.fresh(initial_weights(2, EMBEDDING.dim))
    grad, _ = evaluate_pass(_vectors(spark, folder), EMBEDDING, state.weights)
    state = adamw(state, grad, ADAM_LR)
    folder_out = scratch_path(spark, "adamw")
    saved.save(spark, folder_out, "adamw", 1, state, [(1, "step", float(state.step))])
    weights = saved.read(spark, folder_out, "weights").select("k", "j", _number(F.col("w")).alias("w"))
    moments = saved.read(spark, folder_out, "optimizer_state").select(
        "k", "j", _number(F.col("m"), 9).alias("m"), _number(F.col("v"), 9).alias("v"), "step"
    )
    return weights.join(moments, ["k", "j"])


def _history(spark: SparkSession, run_id: str, series) -> DataFrame:
    return history_frame(spark, run_id, series).withColumn("value", _number(F.col("value")))


def train_history(spark: SparkSession, folder: str) -> DataFrame:
    _, series = fit(_vectors(spark, folder), EMBEDDING, epochs=3, lr=ADAM_LR)
    return _history(spark, "vectors", series)


def train_history_masked(spark: SparkSession, folder: str) -> DataFrame:
    """Training with half of the weights frozen."""
    mask = np.zeros((2, EMBEDDING.dim + 1), dtype=bool)
    mask[:, FROZEN:] = True
    _, series = fit(_vectors(spark, folder), EMBEDDING, epochs=3, lr=ADAM_LR, trainable=mask)
    return _history(spark, "masked", series)


def train_history_text(spark: SparkSession, folder: str) -> DataFrame:
    """Prepare the labelled documents, then train on the written dataset."""
    path = scratch_path(spark, "train-text")
    pp.prepare(tables.load_labelled(spark, folder), path, FILES, vocab=_vocab(spark, folder), max_length=MAX_LENGTH)
    batched = _batched(datasets.scan(spark, path), batch.KEEP_ALL, SMALL_BATCH)
    data = write_steps(batched, scratch_path(spark, "steps"), STEPS)
    features = Features("input_ids", TEXT_DIM, hashed=True)
    _, series = fit(data, features, epochs=2, lr=TEXT_LR, steps_per_epoch=STEPS)
    return _history(spark, "text", series)


def _minibatched(spark: SparkSession, folder: str, rows: DataFrame) -> DataFrame:
    """Rows in as many batches an epoch as the SQL has updates."""
    placed = pp.with_files(rows, FILES)
    layout = _files(placed)
    size = batch.batch_size_for(layout, TRAIN, MINI_STEPS)
    return materialise(batch.with_batches(placed, batch.batch_layout(layout, size, WORLD), size), "minibatches")


def train_history_minibatch(spark: SparkSession, folder: str) -> DataFrame:
    """An update for every batch of all ranks."""
    data = _minibatched(spark, folder, _vectors(spark, folder))
    _, series = fit_minibatches(data, EMBEDDING, epochs=2, lr=ADAM_LR)
    return _history(spark, "minibatch", series)


def checkpoint_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Saved weights and moments next to those in memory."""
    path = scratch_path(spark, "state")
    state, _ = fit(_vectors(spark, folder), EMBEDDING, epochs=2, lr=ADAM_LR, run_id="a", folder=path)
    k, j = (axis.ravel() for axis in np.indices(state.weights.shape))
    memory = spark.createDataFrame(pa.table(
        {"k": k, "j": j, "w_memory": state.weights.ravel(), "m_memory": state.m.ravel()}
    ))
    last = F.col("epoch") == 2
    stored = saved.read(spark, path, "weights").filter(last).join(
        saved.read(spark, path, "optimizer_state").filter(last), ["run_id", "epoch", "k", "j"]
    )
    same = (F.col("w") == F.col("w_memory")) & (F.col("m") == F.col("m_memory"))
    numbers = [_number(F.col(c)).alias(c) for c in ("w", "m", "v")]
    return stored.join(memory, ["k", "j"]).select("k", "j", *numbers, "step", same.alias("same"))


def resume_equals_straight(spark: SparkSession, folder: str) -> DataFrame:
    """Two epochs, then two more from the saved state, against four in one go."""
    data, path = _vectors(spark, folder), scratch_path(spark, "resume")
    _, straight = fit(data, EMBEDDING, epochs=4, lr=ADAM_LR)
    fit(data, EMBEDDING, epochs=2, lr=ADAM_LR, run_id="r", folder=path)
    _, resumed = fit(data, EMBEDDING, epochs=4, lr=ADAM_LR, run_id="r", folder=path)
    pair = history_frame(spark, "straight", straight).unionByName(history_frame(spark, "resumed", resumed))
    wide = pair.groupBy("epoch", "series").pivot("run_id", ["straight", "resumed"]).agg(F.max("value"))
    same = F.abs(F.col("straight") - F.col("resumed")) < 1e-9
    return wide.select("epoch", "series", _number(F.col("resumed")).alias("value"), same.alias("same"))


def latest_checkpoint(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a saved state of its type's run."""
    events = tables.read_table(spark, folder, "events")
    path = F.concat(F.lit("state/"), F.col("event_type"), F.lit("/"), F.col("event_id").cast("string"))
    states = events.select(F.col("event_type").alias("run_id"), path.alias("path"), F.col("ts").alias("created_at"))
    return saved.latest_path(states).select("run_id", "path")


def max_wall_time(spark: SparkSession, folder: str) -> DataFrame:
    """Event values as stage seconds, one shard per event."""
    events = tables.read_table(spark, folder, "events")
    user = F.concat(F.lit("user-"), F.col("user_id").cast("string"))
    return runs.max_wall_time(events.select(
        user.alias("run_id"), F.col("event_type").alias("stage"), F.col("value").alias("seconds")
    ))


# Evaluation.

def predict_argmax(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder).select("doc_id", "pred")


def accuracy(spark: SparkSession, folder: str) -> DataFrame:
    scored = _scored_batches(spark, folder)
    return evaluate.accuracy(scored, "split").withColumn("accuracy", _number(F.col("accuracy")))


def accuracy_per_shard(spark: SparkSession, folder: str) -> DataFrame:
    scored = _scored_batches(spark, folder)
    return evaluate.accuracy(scored, "split", "shard").withColumn("accuracy", _number(F.col("accuracy")))


def eval_loss(spark: SparkSession, folder: str) -> DataFrame:
    scored = _scored_batches(spark, folder).filter(F.col("split") != TRAIN)
    return evaluate.batch_loss(scored, "split").withColumn("loss", _number(F.col("loss")))


def epoch_train_loss(spark: SparkSession, folder: str) -> DataFrame:
    scored = _scored_batches(spark, folder).filter(F.col("split") == TRAIN)
    return evaluate.batch_loss(scored, "split").withColumn("loss", _number(F.col("loss")))


def loss_per_shard(spark: SparkSession, folder: str) -> DataFrame:
    scored = _scored_batches(spark, folder)
    return evaluate.shard_loss(scored).withColumn("loss", _number(F.col("loss")))


def eval_by_dataset(spark: SparkSession, folder: str) -> DataFrame:
    scored = _scored(spark, folder)
    rounded = {c: _number(F.col(c)) for c in ("loss", "accuracy")}
    return evaluate.by_dataset(scored).withColumns(rounded)


def eval_grouping_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Each rank of each split, each split, and everything, in one aggregation."""
    found = evaluate.by_grouping_sets(_scored_batches(spark, folder), "split", "shard")
    return found.withColumns({c: _number(F.col(c)) for c in ("loss", "accuracy")})


def eval_auc(spark: SparkSession, folder: str) -> DataFrame:
    score = evaluate.positive_score(F.col("loss"), F.col("label"))
    found = evaluate.auc(_scored(spark, folder).withColumn("score", score), "split")
    return found.withColumn("auc", _number(F.col("auc")))


def prediction_listing(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.prediction_listing(_scored_batches(spark, folder), "doc_id")


# Reports.

def _plain_run(spark: SparkSession, folder: str, run_id: str, lr: float) -> DataFrame:
    """Losses by split before and after one plain step, as a run's history."""
    data = _vectors(spark, folder)
    series = []
    heads = [initial_weights(2, EMBEDDING.dim), one_plain_step(data, EMBEDDING, 2, lr)]
    names = {"train": "train_losses", "test": "imdb_eval_losses", "sst2": "sst2_eval_losses"}
    for epoch, weights in enumerate(heads, 1):
        _, metrics = evaluate_pass(data, EMBEDDING, weights)
        series += [(epoch, names[s], m[1]) for s, m in metrics.items()]
    return history_frame(spark, run_id, series)


def loss_curves_long(spark: SparkSession, folder: str) -> DataFrame:
    wide = report.wide_history(_plain_run(spark, folder, "a", 1.0))
    return report.loss_curves(wide).withColumn("value", _number(F.col("value")))


def history_rounded(spark: SparkSession, folder: str) -> DataFrame:
    both = _plain_run(spark, folder, "a", 1.0).unionByName(_plain_run(spark, folder, "b", 0.5))
    return report.rounded_by_run(both, ["a", "b"])


def run_metrics_append(spark: SparkSession, folder: str) -> DataFrame:
    """Sweep points over the labelled documents, with the rows each prepared."""
    root = scratch_path(spark, "sweep")
    labelled = tables.load_labelled(spark, folder)
    ps.sweep(
        labelled, f"{root}/data", f"{root}/metrics", samples=SWEEP_SAMPLES, files=SWEEP_FILES, epochs=SWEEP_EPOCHS,
        vocab=_vocab(spark, folder), steps_per_epoch=STEPS,
    )
    recorded = ps.recorded_runs(runs.read_metrics(spark, f"{root}/metrics"))
    rows = spark.read.parquet(f"{root}/data").groupBy("run_id").agg(F.count(F.lit(1)).alias("rows"))
    return recorded.join(rows, "run_id")


# Streaming.

def stream_encode(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows, stored encoded."""
    root = scratch_path(spark, "stream-encoded")
    store.append(tables.load_labelled(spark, folder), f"{root}/in")
    return _streamed(spark, folder, root, oe.BROADCAST_TOKENS)


def stream_encode_join(spark: SparkSession, folder: str) -> DataFrame:
    """The same with a vocabulary over the broadcast bound."""
    root = scratch_path(spark, "stream-joined")
    store.append(tables.load_labelled(spark, folder), f"{root}/in")
    return _streamed(spark, folder, root, 0)


def _streamed(spark: SparkSession, folder: str, root: str, max_tokens: int) -> DataFrame:
    vocab = _vocab(spark, folder)
    arrivals = ingest.read_arrivals(spark, f"{root}/in")
    ingest.append_arrivals(
        arrivals, f"{root}/out", f"{root}/checkpoint", vocab, MAX_LENGTH, max_tokens=max_tokens
    ).awaitTermination()
    stored = spark.read.parquet(f"{root}/out")
    return stored.select("doc_id", "label", "split", _joined("input_ids").alias("input_ids"))


def stream_encode_grown(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs into one store: the vocabulary is over the bound from the second on."""
    root = scratch_path(spark, "stream-grown")
    rows = tables.load_labelled(spark, folder)
    store.append(rows.filter("doc_id % 2 = 0"), f"{root}/in")
    _streamed(spark, folder, root, oe.BROADCAST_TOKENS)
    store.append(rows.filter("doc_id % 2 = 1"), f"{root}/in")
    return _streamed(spark, folder, root, 0)


def stream_append(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled rows arriving as files, prepared and appended to a store."""
    root = scratch_path(spark, "stream")
    store.append(tables.load_labelled(spark, folder), f"{root}/in")
    arrivals = ingest.read_arrivals(spark, f"{root}/in")
    ingest.append_arrivals(arrivals, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out").select("doc_id", "text", "label", "source", "split")


ARRIVALS = "doc_id bigint, split string, shard int, pred int, label int, at timestamp"


def stream_running_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy so far of each rank by batch, when every second batch comes late and after a restart."""
    root = scratch_path(spark, "running")
    rows = _scored_batches(spark, folder).withColumn("at", F.timestamp_seconds(F.col("batch_id") + EPOCH))
    rows = materialise(rows.withColumn("late", F.col("batch_id") % 2), "arrivals")
    end = rows.agg((F.unix_seconds(F.max("at")) + 2 * LATEST).alias("end"))
    # A row that is far ahead closes what is open.
    mark = end.select(
        F.lit("").alias("split"), F.lit(-1).alias("shard"), F.timestamp_seconds("end").alias("at"),
        *[F.lit(None).cast(kind).alias(c) for c, kind in (("doc_id", "long"), ("pred", "int"), ("label", "int"))],
    )
    for part in (rows.filter("late = 0"), rows.filter("late = 1"), mark):
        store.append(part.select("doc_id", "split", "shard", "pred", F.col("label").cast("int"), "at"), f"{root}/in")
        arrivals = spark.readStream.schema(ARRIVALS).parquet(f"{root}/in")
        running.append_running(
            arrivals, f"{root}/out", f"{root}/checkpoint", f"{LATEST} seconds"
        ).awaitTermination()
    found = spark.read.parquet(f"{root}/out")
    accuracy = _number(F.col("seen_correct") / F.col("seen")).alias("accuracy")
    return found.select("split", "shard", (F.col("window") - EPOCH).alias("batch_id"), "correct", "total", "seen_correct", "seen", accuracy)


QUERIES = {f.__name__: f for f in (
    load_in_domain, load_out_domain, concat_splits, tag_and_union, select_source,
    store_append_roundtrip, store_append_run, store_overwrite_named, jsonl_sample, parquet_roundtrip_counts,
    prepare_reuse, prepare_increment, shard_rows_few_files, keyless_corpus, manifest_lookup,
    clean_text, clean_text_edge, strip_punct, min_length_clean, min_length_raw,
    build_vocab, build_piece_vocab, encode_ids, encode_ids_join, encode_repeated_keys, encode_truncation, attention_mask,
    encoded_projection, wordpiece_words, wordpiece_encode, wordpiece_encode_join,
    seeded_shuffle, hash_split, split_counts, sample_cap, sample_cap_stratified, partition_balance,
    shard_drop_remainder, shard_last_takes_rest, batch_drop_last, batch_keep_last, batch_few_files,
    batches_per_shard, min_batches, batch_truncate, batch_by_length,
    head_init_loss, gradient_step, adamw_step, train_history, train_history_masked, train_history_text,
    train_history_minibatch,
    checkpoint_roundtrip, resume_equals_straight, latest_checkpoint, max_wall_time,
    predict_argmax, accuracy, accuracy_per_shard, eval_loss, epoch_train_loss, loss_per_shard,
    eval_by_dataset, eval_grouping_sets, eval_auc, prediction_listing, loss_curves_long, history_rounded, run_metrics_append,
    stream_append, stream_encode, stream_encode_join, stream_encode_grown, stream_running_accuracy,
)}
