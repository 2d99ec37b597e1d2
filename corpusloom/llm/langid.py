"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from corpusloom.llm.text import blocks, buffers
from corpusloom.session import parallelism

UNDETERMINED = "und"
# Buckets that n-grams of one to three letters are hashed to.
BUCKET_BITS = 15
# The model is languages x buckets numbers; this bounds it to 64 MB.
MAX_LANGUAGES = 256
SMOOTHING = 0.5
# Counts travel in slices, so that no row grows with the model.
SLICES = 8
_PARTS = 16

_tables: list[np.ndarray] = []


def _letter_tables() -> list[np.ndarray]:
    """For each code point its lower-case form, 32 if it is no letter; made once a worker."""
    if not _tables:
        points = 0x110000
        lower = np.full(points, 32, dtype=np.uint32)
        for c in range(points):
            s = chr(c)
            if s.isalpha():
                low = s.lower()
                lower[c] = ord(low) if len(low) == 1 else c
        _tables.append(lower)
    return _tables


def grams(data: np.ndarray, off: np.ndarray, bits: int = BUCKET_BITS):
    """Bucket and row of every n-gram of one to three letters, with word edges, in a block.

    Anything but letters separates words.  The n-grams of one length come row by row.
    """
    lower = _letter_tables()[0]
    text = data.tobytes().decode("utf-8", "replace")
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    lead = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    chars = lead[off]
    if chars[-1] != len(points):  # not valid UTF-8: decode row by row
        rows = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(off[:-1], off[1:])]
        points = np.frombuffer("".join(rows).encode("utf-32-le"), dtype=np.uint32)
        chars = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    n = len(points)
    # A separator before, between and after rows keeps n-grams inside them.
    c = np.full(n + len(off) + 1, 32, dtype=np.uint32)
    row_of = np.repeat(np.arange(len(off) - 1), np.diff(chars))
    c[np.arange(n) + row_of + 1] = lower[points]
    row = np.empty(len(c), dtype=np.int32)
    row[0] = 0
    row[1:] = np.minimum(
        np.repeat(np.arange(len(off)), np.append(np.diff(chars) + 1, 1)), max(len(off) - 2, 0)
    )
    letter = c != 32
    shift = np.uint32(32 - bits)
    spread, step = np.uint32(0x9E3779B1), np.uint32(0x01000193)
    two = c[:-1] * step + c[1:]
    three = two[:-1] * step + c[2:]
    found = []
    for n_gram, keep, at in (
        (c, letter, 0), (two, letter[:-1] | letter[1:], 0), (three, letter[1:-1], 1),
    ):
        where = np.flatnonzero(keep)
        code = n_gram[where] + np.uint32(len(found) + 1)
        code = (code ^ (code >> np.uint32(15))) * spread
        # An n-gram that begins on a separator belongs to the row of its first letter.
        first = where + at
        first = first + (~letter[first])
        found.append(((code >> shift).astype(np.int32), row[first]))
    return found


def _count(texts: str, label: str, bits: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << bits
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            data, off = buffers(batch.column(0))
            coded = batch.column(1).dictionary_encode()
            code, names = coded.indices.to_numpy(), coded.dictionary.to_pylist()
            for name in names:
                sums.setdefault(name, np.zeros(size + 1, dtype=np.int64))
            for at, name in enumerate(names):
                sums[name][size] += int((code == at).sum())
            for a, b in blocks(off):
                part = off[a : b + 1]
                total = np.zeros(len(names) * size, dtype=np.int64)
                for bucket, row in grams(data[part[0] : part[-1]], part - part[0], bits):
                    total += np.bincount(code[a:b][row].astype(np.int64) * size + bucket, minlength=len(total))
                for at, name in enumerate(names):
                    sums[name][:size] += total[at * size : (at + 1) * size]
        part = TaskContext.get().partitionId() % _PARTS
        yield from _sliced(sums, part)

    return count


def _sliced(sums: dict[str, np.ndarray], part: int) -> Iterator[pa.RecordBatch]:
    for name, values in sums.items():
        pieces = np.array_split(values, SLICES)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([name] * SLICES), pa.array(range(SLICES), pa.int32()),
                pa.array([part] * SLICES, pa.int32()), pa.array([p.tobytes() for p in pieces], pa.binary()),
            ],
            ["lang", "slice", "part", "counts"],
        )


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple, np.ndarray] = {}
    for batch in batches:
        for row in batch.to_pylist():
            key = (row["lang"], row["slice"], row["part"])
            values = np.frombuffer(row["counts"], dtype=np.int64)
            sums[key] = sums[key] + values if key in sums else values
    keys = list(sums)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
            pa.array([k[2] for k in keys], pa.int32()),
            pa.array([sums[k].tobytes() for k in keys], pa.binary()),
        ],
        ["lang", "slice", "part", "counts"],
    )


class Model:
    """Sorted languages, their log priors, and log probabilities by bucket and language."""

    def __init__(self, languages: list[str], prior: np.ndarray, logp: np.ndarray, bits: int):
        self.languages, self.prior, self.logp, self.bits = languages, prior, logp, bits


def learn(rows: DataFrame, text: str = "text", label: str = "lang", bits: int = BUCKET_BITS) -> Model:
    """The model of all rows with a text and a label.

    Each task sums its own rows to one vector per language; the vectors are added in two
    steps, so the work at one place depends on the model's size alone.  The driver gets
    languages x buckets counts, at most `MAX_LANGUAGES` x 2^bits; more languages raise.
    No rows give a model without languages.
    """
    schema = "lang string, slice int, part int, counts binary"
    labelled = rows.select(F.col(text).alias("text"), F.col(label).alias("lang")).filter(
        "text is not null and lang is not null"
    )
    few = min(64, parallelism(rows.sparkSession))
    partial = labelled.mapInArrow(_count("text", "lang", bits), schema)
    added = partial.repartition(few, "lang", "slice", "part").mapInArrow(_add, schema)
    merged = added.withColumn("part", F.lit(0)).repartition(few, "lang", "slice").mapInArrow(_add, schema)
    limited = merged.limit(SLICES * MAX_LANGUAGES + 1).collect()
    if len(limited) > SLICES * MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    pieces: dict[str, dict[int, np.ndarray]] = {}
    for row in limited:
        pieces.setdefault(row.lang, {})[row.slice] = np.frombuffer(row.counts, dtype=np.int64)
    languages = sorted(pieces)
    size = 1 << bits
    if not languages:
        return Model([], np.zeros(0), np.zeros((size, 0), np.float32), bits)
    counts = np.stack([np.concatenate([pieces[k][s] for s in range(SLICES)]) for k in languages])
    seen = counts[:, :size] + SMOOTHING
    logp = np.log(seen / seen.sum(axis=1, keepdims=True)).T
    prior = np.log(counts[:, size] / counts[:, size].sum())
    return Model(languages, prior, np.ascontiguousarray(logp, dtype=np.float32), bits)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add `lang_pred` and `score`, the posterior probability of the prediction.

    A text that is null or has no letter, or a model without languages, gives `und` and 0.
    Ties go to the language that sorts first.  Columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score")
    names = docs.columns
    place = names.index(text)
    schema = StructType([*docs.schema.fields]).add("lang_pred", "string").add("score", "double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        count = len(m.languages)
        tables = [np.ascontiguousarray(m.logp[:, k]) for k in range(count)]
        labels = pa.array(m.languages + [UNDETERMINED])
        for batch in batches:
            data, off = buffers(batch.column(place))
            rows = batch.num_rows
            total, seen = np.zeros((rows, count)), np.zeros(rows, dtype=np.int64)
            for a, b in blocks(off):
                part = off[a : b + 1]
                for bucket, row in grams(data[part[0] : part[-1]], part - part[0], m.bits):
                    if not len(row):
                        continue
                    seen[a:b] += np.bincount(row, minlength=b - a)
                    starts = np.flatnonzero(np.diff(row, prepend=-1))
                    for k in range(count):
                        sums = np.add.reduceat(tables[k][bucket], starts, dtype=np.float64)
                        total[a + row[starts], k] += sums
            best = np.full(rows, count)
            sure = np.zeros(rows)
            known = (seen > 0) if count else np.zeros(rows, dtype=bool)
            if known.any():
                z = total[known] + m.prior
                best[known] = z.argmax(axis=1)
                sure[known] = 1.0 / np.exp(z - z.max(axis=1, keepdims=True)).sum(axis=1)
            columns = [*batch.columns, labels.take(pa.array(best)), pa.array(sure)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "lang_pred", "score"])

    return docs.mapInArrow(score, schema)


def held_out(doc_id: str = "doc_id"):
    """True where the checksum of the id falls in the third that is not learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(documents: DataFrame) -> DataFrame:
    """`documents` with `held_out`, `lang_pred` and `score`.

    Learns from the rows that are not held out and have an id and a label, and reads no
    column but the text to predict.  Null ids are predicted but not learned from.
    Repeated rows count as often as they occur.
    """
    out = documents.withColumn("held_out", held_out())
    model = learn(out.filter("not held_out and doc_id is not null"))
    return predict(out, model)
