"""From labelled rows to written, encoded splits."""

from __future__ import annotations

import inspect
import json
import uuid

from pyspark.sql import DataFrame, functions as F

from corpusloom.functions.clean import clean_and_filter
from corpusloom.functions.hashing import file_number
from corpusloom.operators import sample
from corpusloom.operators.encode import broadcast_vocab, encode, encode_with
from corpusloom.operators.split import cap_for_split, with_split
from corpusloom.operators.vocab import build_piece_vocab, build_vocab
from corpusloom.schemas import MAX_LENGTH
from corpusloom.session import materialise, path_exists, scratch
from corpusloom.sources import datasets, tables


def split_rows(labelled: DataFrame) -> DataFrame:
    """Cleaned rows of sufficient length with their split; narrow from end to end.

    The split is a function of the key, so it is placed before the text work.
    """
    return clean_and_filter(with_split(labelled))


def capped_rows(labelled: DataFrame, samples: int | None, stratify: str | None = None) -> DataFrame:
    """`split_rows` under the sample cap, cleaning little more than the sample, and each text once.

    One pass over keys sketches the order numbers of each split, and gives the cells that
    let a quarter more than the cap through.  Their rows are cleaned and written; where too few of
    them are long enough, as many cells again are cleaned in addition.  The result is that
    of capping after cleaning everything, since the cap takes the least order numbers.

    `stratify` names a column whose shares among all rows of a split, short texts included,
    the sample keeps, to one row.  A group with too few long texts gives all of those.
    """
    if not samples or samples <= 0:
        return split_rows(labelled)
    keyed = with_split(labelled)
    by = [stratify] if stratify else []
    groups = ["split", *by]
    sketch = sample.with_quota(sample.order_sketch(keyed, groups), cap_for_split(samples), ["split"], by)
    found = sample.with_edge(sketch, F.col("quota") * 1.25 + 64).collect()
    strata = [{**r.asDict(), "low": 0} for r in found]
    short, parts = strata, []
    while short:
        part = clean_and_filter(sample.between_edges(keyed, short, groups))
        parts.append(materialise(part, "leading"))
        counted = tables.stack(*parts).groupBy(*groups).count().collect()
        kept = {tuple(r)[:-1]: r["count"] for r in counted}
        short = [
            s for s in short
            if s["edge"] < sample.CELLS and kept.get(tuple(s[g] for g in groups), 0) < s["quota"]
        ]
        for s in short:
            s["low"], s["edge"] = s["edge"], min(sample.CELLS, 2 * s["edge"])
    if not parts:
        return clean_and_filter(keyed).limit(0)
    return sample.head_of_groups(tables.stack(*parts), strata, groups)


def encode_arranged(
    rows: DataFrame, vocab: DataFrame, files: int, max_length: int, pieces: bool, pretrained_words: bool
) -> DataFrame:
    """Encoded rows in the partition and order they are to be written in."""
    shared = broadcast_vocab(vocab)
    if shared is not None:
        fitting = F.substring_index("text", " ", max_length - 2)
        placed = datasets.arrange(rows.withColumn("text", fitting), files)
        return encode_with(placed, shared, max_length, pieces=pieces, pretrained_words=pretrained_words)
    kept = rows.select("doc_id", "split", "label", "text")
    encoded = encode(kept, vocab, max_length, pieces=pieces, pretrained_words=pretrained_words, keep_text=False)
    return datasets.arrange(encoded, files)


def prepare(
    labelled: DataFrame,
    path: str,
    files: int,
    vocab: DataFrame | None = None,
    vocab_size: int = 30_000,
    pieces: bool = False,
    piece_count: int = 30_000,
    samples: int | None = None,
    max_length: int = MAX_LENGTH,
    manifest: str | None = None,
    run_id: str | None = None,
    pretrained_words: bool = False,
    request: str = "",
    stratify: str | None = None,
) -> str:
    """Write `(doc_id, label, input_ids, attention_mask)` under `path/split=...`.

    Capping comes before encoding, and encoding after the shuffle that evens the files:
    the shuffle moves only the words that fit, not whole texts or padded arrays, and each
    task encodes the rows it writes, already in order.  One job writes every split.  What is
    written in between is deleted at the end.
    """
    run_id = run_id or uuid.uuid4().hex
    with scratch(labelled.sparkSession):
        rows = capped_rows(labelled, samples, stratify)
        if vocab is None:
            corpus = clean_and_filter(labelled.select("text"))
            vocab = (
                build_piece_vocab(corpus, vocab_size, piece_count) if pieces else build_vocab(corpus, vocab_size)
            )
            vocab = materialise(vocab, "vocab")
        encoded = encode_arranged(rows, vocab, files, max_length, pieces, pretrained_words)
        datasets.write_arranged(encoded.select("doc_id", "split", "label", "encoding.*"), path)
    if manifest:
        datasets.record_manifest(labelled.sparkSession, manifest, run_id, path, request)
    return path


def content_identity(df: DataFrame) -> str:
    """Row count and an order-free sum of row hashes: equal for equal rows."""
    row = df.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("h")
    ).first()
    return f"{row.n}:{row.h}"


def request_of(labelled: DataFrame, files: int, **options) -> str:
    """What `prepare` would make: its options, and the identity of corpus and vocabulary."""
    bound = inspect.signature(prepare).bind(labelled, "", files, **options)
    bound.apply_defaults()
    given = {k: v for k, v in bound.arguments.items() if k not in ("labelled", "path", "manifest", "run_id", "request")}
    vocab = given.pop("vocab")
    given["vocab"] = None if vocab is None else content_identity(vocab.select("token", "id"))
    given["corpus"] = content_identity(labelled.select("doc_id", "text", "label", "source"))
    given["samples"] = given["samples"] or 0
    return json.dumps(given, sort_keys=True)


def prepare_or_reuse(labelled: DataFrame, root: str, files: int, **options) -> str:
    """The newest complete dataset under `root` made from the same rows with the same
    options, or a newly prepared one.  Costs one pass over the corpus to tell."""
    spark = labelled.sparkSession
    manifest = f"{root}/manifest"
    request = request_of(labelled, files, **options)
    if path_exists(spark, manifest):
        found = datasets.find_cached(datasets.read_manifest(spark, manifest), request)
        if found:
            return found["train_path"]
    run_id = uuid.uuid4().hex
    return prepare(
        labelled, f"{root}/dataset-{run_id}", files, manifest=manifest, run_id=run_id, request=request, **options
    )


def corpus_summary(rows: DataFrame) -> DataFrame:
    """Rows and mean text length per split and label: what the training set looks like."""
    return rows.groupBy("split", "label").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg(F.length("text")), 6).alias("mean_chars")
    )


def with_files(rows: DataFrame, files: int, key: str = "doc_id") -> DataFrame:
    """The file each row is written to, for plans that do not write."""
    return rows.withColumn("file", file_number(F.col(key), files))

