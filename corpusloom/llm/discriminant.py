"""Quality of texts by a regularised quadratic discriminant over their statistics.

Each text becomes a short vector of statistics: logarithms of sizes and log odds of
shares (capitals, marks, digits, repeated words, short lines, ...).  Each class is a
normal distribution with its own mean and its own covariance, shrunk towards a multiple
of the identity by the oracle-approximating amount, which follows from the number of rows.
A text's score is the logistic of the difference of the two log densities, whose
Mahalanobis lengths come from the inverse Cholesky factors made once with the model.

Statistics are whole numbers (steps of 2^-12), so sums over rows are exact and a model
does not depend on partitioning, order or retries.

- A null text is an empty one; both have a score.  Whole texts are read.
- Learned from are labelled rows with label 0 or 1 and an id, outside the withheld part,
  all of them: a row counts once for each of its labels.
- If only one class has rows, or none has, every score is the share of label 1, or 1/2.
- Repeated ids are rows of their own; extra columns are kept by `score_quality`, and its
  own columns replace those of the same names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from corpusloom.llm.frames import spread_join
from corpusloom.llm.text import SOLID, blocks, buffers, hash_spans, row_starts, runs
from corpusloom.session import materialise

STATISTICS = (
    "chars", "words", "lines", "word_length", "longest_word", "words_a_line", "words_a_sentence",
    "capitals", "digits", "stops", "commas", "calls", "symbols", "bars", "spaces", "other_letters",
    "capital_words", "upper_words", "letterless_words", "mark_ended_words", "new_words", "new_pairs",
    "short_lines", "open_lines", "new_lines",
)
STEP = 1 << 12
GOOD_FROM = 0.7
# Least variance of a standardised statistic, for classes of few or equal rows.
LEAST_VARIANCE = 1e-3
# Lines of at most this many words are short.
SHORT_LINE = 5
_DECIMAL = pa.decimal128(38, 0)


def _class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


_UPPER, _DIGIT = _class((0x41, 0x5A)), _class((0x30, 0x39))
_STOP, _COMMA, _CALL, _BAR = (_class(*((ord(c), ord(c)) for c in marks)) for marks in (".?", ",;:", "!", "|"))
_HIGH, _LEAD = _class((0x80, 0xFF)), ~_class((0x80, 0xBF))
_LETTER = _class((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_SYMBOL = _class((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)) & ~(_STOP | _COMMA | _CALL | _BAR | _class((0x22, 0x22), (0x27, 0x29), (0x2D, 0x2D)))
_NEWLINE = _class((0x0A, 0x0A))


def _odds(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Log odds of a share, with half a case on either side."""
    return np.log((part + 0.5) / (np.maximum(whole - part, 0) + 0.5))


def _distinct(row: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    """How many different values each row has."""
    order = np.lexsort((value, row))
    r, v = row[order], value[order]
    new = np.ones(len(r), dtype=bool)
    new[1:] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
    return np.bincount(r[new], minlength=rows)


def block_statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The statistics of each row of a block of texts, in steps of 2^-12."""
    rows = len(off) - 1
    byte_row = np.repeat(np.arange(rows), np.diff(off))

    def bytes_of(kind: np.ndarray) -> np.ndarray:
        return np.bincount(byte_row[kind[data]], minlength=rows)

    chars = bytes_of(_LEAD)
    s, e, bounds = runs(SOLID[data], off)
    words = np.diff(bounds)
    word_row = np.repeat(np.arange(rows), words)
    hashes = hash_spans(data, s, e)
    lead = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(_LEAD[data], out=lead[1:])
    length = lead[e] - lead[s]
    longest = np.zeros(rows, dtype=np.int64)
    np.maximum.at(longest, word_row, length)

    def within(kind: np.ndarray) -> np.ndarray:
        total = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(kind[data], out=total[1:])
        return total[e] - total[s]

    def words_of(which: np.ndarray) -> np.ndarray:
        return np.bincount(word_row[which], minlength=rows)

    letters, uppers = within(_LETTER), within(_UPPER)
    last = data[e - 1] if len(e) else np.zeros(0, np.uint8)
    first = data[s] if len(s) else np.zeros(0, np.uint8)
    pair = (word_row[1:] == word_row[:-1]) if len(word_row) else np.zeros(0, bool)
    pairs = hashes[:-1][pair] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:][pair] if len(hashes) else hashes
    pair_row = word_row[1:][pair] if len(word_row) else word_row

    # Lines that have a word: by the number of line ends before each word.
    ends = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(_NEWLINE[data], out=ends[1:])
    opens = np.ones(len(s), dtype=bool)
    if len(s):
        opens[1:] = (word_row[1:] != word_row[:-1]) | (ends[s[1:]] != ends[s[:-1]])
    at = np.flatnonzero(opens)
    close = np.append(at[1:], len(s))
    line_row = word_row[at]
    lines = np.bincount(line_row, minlength=rows)
    line_words = close - at
    line_hash = hash_spans(data, s[at], e[close - 1]) if len(at) else np.zeros(0, np.uint64)
    open_end = ~(_STOP | _CALL)[last[close - 1]] if len(at) else np.zeros(0, bool)
    sentences = words_of(_STOP[last])

    share = lambda which, whole: _odds(which, whole)
    columns = [
        np.log1p(chars), np.log1p(words), np.log1p(lines),
        np.log((length_sum := np.bincount(word_row, length, rows)) + 5.0) - np.log(words + 1.0),
        np.log1p(longest), np.log((words + 1.0) / (lines + 1.0)), np.log((words + 1.0) / (sentences + 1.0)),
        share(bytes_of(_UPPER), chars), share(bytes_of(_DIGIT), chars), share(bytes_of(_STOP), chars),
        share(bytes_of(_COMMA), chars), share(bytes_of(_CALL), chars), share(bytes_of(_SYMBOL), chars),
        share(bytes_of(_BAR), chars), share(chars - length_sum, chars), share(bytes_of(_HIGH & _LEAD), chars),
        share(words_of(_UPPER[first]), words), share(words_of((uppers > 1) & (uppers == within(_LETTER & ~_HIGH))), words),
        share(words_of(letters == 0), words), share(words_of((_SYMBOL | _CALL)[last]), words),
        share(_distinct(word_row, hashes, rows), words), share(_distinct(pair_row, pairs, rows), np.maximum(words - 1, 0)),
        share(np.bincount(line_row[line_words <= SHORT_LINE], minlength=rows), lines),
        share(np.bincount(line_row[open_end], minlength=rows), lines),
        share(_distinct(line_row, line_hash, rows), lines),
    ]
    return np.rint(np.stack(columns, axis=1) * STEP).astype(np.int64)


def text_statistics(docs: DataFrame, text: str = "text", name: str = "statistics") -> DataFrame:
    """`docs` with the column `name`, one whole number for each of `STATISTICS`, in place of the text."""
    fields = [f for f in docs.schema.fields if f.name not in (text, name)]
    kept = [f.name for f in fields]
    rows = docs.select(*kept, text)
    schema = StructType(fields).add(name, ArrayType(IntegerType()))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(len(kept)))
            parts = [np.zeros((0, len(STATISTICS)), np.int64)]
            for a, b in blocks(off):
                own = off[a : b + 1]
                parts.append(block_statistics(data[own[0] : own[-1]], own - own[0]))
            flat = pa.array(np.concatenate(parts).ravel(), pa.int32())
            ends = pa.array(np.arange(batch.num_rows + 1) * len(STATISTICS), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.ListArray.from_arrays(ends, flat)], [*kept, name])

    return rows.mapInArrow(measure, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    width = len(STATISTICS)
    sums: dict[tuple[int, int, int], int] = {}
    low, high = np.triu_indices(width)
    for batch in batches:
        if not batch.num_rows:
            continue
        x = np.concatenate([np.ones((batch.num_rows, 1), np.int64), _matrix(batch.column(0))], axis=1)
        for label in (0, 1):
            w = batch.column(1 + label).to_numpy(zero_copy_only=False).astype(np.int64)
            own = x[w > 0] if w.max() < STEP else x[w > 0].astype(object)
            if len(own):
                total = (own * w[w > 0][:, None]).T @ own
                for i, j in zip(*np.triu_indices(width + 1)):
                    key = (label, int(i), int(j))
                    sums[key] = sums.get(key, 0) + int(total[i, j])
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([k[0] for k in sums], pa.int32()), pa.array([k[1] for k in sums], pa.int32()),
            pa.array([k[2] for k in sums], pa.int32()), pa.array([Decimal(v) for v in sums.values()], _DECIMAL),
        ],
        ["label", "i", "j", "total"],
    )


@dataclass
class Discriminant:
    """Two shrunk normal distributions of standardised statistics.

    `factors` are inverses of the lower Cholesky factors, made once for all rows.
    """

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    logdets: np.ndarray
    log_prior: float
    plain: float | None = None

    def log_ratio(self, x: np.ndarray) -> np.ndarray:
        """Log density of label 1 less that of label 0, with the prior, for rows of statistics."""
        z = (x / STEP - self.centre) / self.scale
        lengths = [
            (np.einsum("nd,kd->nk", z - mean, factor) ** 2).sum(axis=1) for mean, factor in zip(self.means, self.factors)
        ]
        return 0.5 * (lengths[0] - lengths[1]) + 0.5 * (self.logdets[0] - self.logdets[1]) + self.log_prior

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.plain is not None:
            return np.full(len(x), self.plain)
        return 1.0 / (1.0 + np.exp(-np.clip(self.log_ratio(x), -700, 700)))


def shrink(covariance: np.ndarray, rows: int) -> tuple[np.ndarray, float]:
    """The covariance moved towards a multiple of the identity, and by how much.

    The share is the oracle-approximating one of Chen, Wiesel, Eldar and Hero (2010).
    """
    p = len(covariance)
    trace, square = np.trace(covariance), (covariance**2).sum()
    spread = (rows + 1 - 2 / p) * (square - trace**2 / p)
    share = 1.0 if spread <= 0 else min(1.0, ((1 - 2 / p) * square + trace**2) / spread)
    target = max(trace / p, LEAST_VARIANCE)
    out = (1 - share) * covariance + share * target * np.eye(p)
    return out + LEAST_VARIANCE * np.eye(p), share


def model_of(sums: dict[tuple[int, int, int], int]) -> Discriminant:
    """The model of exact sums (label, i, j) of products, 0 standing for the constant 1."""
    width = len(STATISTICS)
    n = [sums.get((k, 0, 0), 0) for k in (0, 1)]
    nothing = np.zeros(0)
    if not all(n):
        return Discriminant(nothing, nothing, nothing, nothing, nothing, 0.0, n[1] / sum(n) if sum(n) else 0.5)
    whole = {key: sums.get((0, *key), 0) + sums.get((1, *key), 0) for key in [(i, j) for i in range(width + 1) for j in range(i, width + 1)]}

    def covariance(total, count: int) -> tuple[np.ndarray, np.ndarray]:
        # Products of sums are taken in whole numbers, so nothing cancels.
        mean = np.array([total(0, j) / count / STEP for j in range(1, width + 1)])
        out = np.empty((width, width))
        for i in range(width):
            for j in range(i, width):
                top = count * total(i + 1, j + 1) - total(0, i + 1) * total(0, j + 1)
                out[i, j] = out[j, i] = top / (count * count) / (STEP * STEP)
        return mean, out

    centre, spread = covariance(lambda i, j: whole[i, j], sum(n))
    scale = np.sqrt(np.maximum(np.diag(spread), 1e-6))
    means, factors, logdets = [], [], []
    for k in (0, 1):
        mean, own = covariance(lambda i, j, k=k: sums[k, i, j], n[k])
        shrunk, _ = shrink(own / np.outer(scale, scale), n[k])
        lower = np.linalg.cholesky(shrunk)
        means.append((mean - centre) / scale)
        factors.append(np.linalg.inv(lower))
        logdets.append(2 * np.log(np.diag(lower)).sum())
    return Discriminant(centre, scale, np.array(means), np.array(factors), np.array(logdets), float(np.log(n[1] / n[0])))


def learn(measured: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", name: str = "statistics") -> Discriminant:
    """The model of the measured rows that have labels.

    Labels are counted per id first, so a row of either side meets at most one of the
    other; rows of a repeated id are spread.  The driver gets 702 sums.
    """
    counted = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(key).agg(
        F.count_if(F.col(label) == 0).alias("poor"), F.count_if(F.col(label) == 1).alias("good")
    )
    rows = measured.filter(F.col(key).isNotNull()).select(F.col(key), F.col(name).alias("statistics"))
    joined = spread_join(rows, counted, key, "inner").select("statistics", "poor", "good")
    partial = joined.mapInArrow(_moments, "label int, i int, j int, total decimal(38,0)")
    found = partial.groupBy("label", "i", "j").agg(F.sum("total").alias("total")).collect()
    return model_of({(r.label, r.i, r.j): int(r.total) for r in found})


def predict(measured: DataFrame, model: Discriminant, name: str = "statistics") -> DataFrame:
    """Measured rows with `score` in place of their statistics."""
    shared = measured.sparkSession.sparkContext.broadcast(model)
    fields = [f for f in measured.schema.fields if f.name not in (name, "score")]
    kept = [f.name for f in fields]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = shared.value.score(_matrix(batch.column(len(kept))))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found)], [*kept, "score"])

    return measured.select(*kept, name).mapInArrow(score, StructType(fields).add("score", "double"))


def held_out(key: str = "doc_id") -> Column:
    """True where the checksum of the id falls in the quarter that is not learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score_quality(documents: DataFrame, labels: DataFrame, least: float = GOOD_FROM) -> DataFrame:
    """`documents` without their text, with `held_out`, `score` and `predicted`.

    Texts are read once: the statistics are written and both learning and scoring read them.
    """
    rows = documents.drop("statistics", "score", "predicted").withColumn("held_out", held_out())
    measured = materialise(text_statistics(rows), "statistics")
    model = learn(measured.filter("not held_out"), labels)
    return predict(measured, model).withColumn("predicted", (F.col("score") >= least).cast("int"))
