"""Document fingerprints by winnowing.

Every run of `GRAM` code points is hashed; of each window of `WINDOW` hashes the least is
chosen, the rightmost of equals.  Two texts that share `GRAM + WINDOW - 1` code points in a
row share a chosen hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from corpusloom.llm.text import mix, numbers, powers
from corpusloom.session import materialise, parallelism

GRAM = 12
WINDOW = 40

_POINTS = numbers(1 << 16, 77)


def gram_hashes(points: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Rolling 32-bit hash of every `gram` code points; one of the whole if it is shorter."""
    n = len(points)
    if not n:
        return np.zeros(0, np.uint64)
    width = min(gram, n)
    value = _POINTS[points & 0xFFFF] + points.astype(np.uint64)
    out = np.empty(n - width + 1, dtype=np.uint64)
    step = 1 << 20
    for a in range(0, len(out), step):  # a long text in parts, so that the powers stay few
        b = min(len(out), a + step)
        part = value[a : b + width - 1]
        power, inverse = powers(len(part) + 1)
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part * power[: len(part)], out=total[1:])
        out[a:b] = (total[width:] - total[:-width]) * inverse[: b - a]
    return mix(out + np.uint64(width)) >> np.uint64(32)


def winnow(points: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Chosen hashes and their positions, in order of position."""
    hashes = gram_hashes(points, gram)
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    # Hash above, position from the right below: the least is the rightmost least.
    last = np.uint64(0xFFFFFFFF)
    low = (hashes << np.uint64(32)) | (last - np.arange(n, dtype=np.uint64))
    size, reach = 1, min(window, n)
    while 2 * size <= reach:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < reach:
        low = np.minimum(low[: n - reach + 1], low[reach - size :])
    chosen = low[np.r_[True, low[1:] != low[:-1]]]
    at = (last - (chosen & last)).astype(np.int64)
    return (chosen >> np.uint64(32)).astype(np.uint32), at


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the chosen hashes of two texts that both have; 1 if neither has any."""
    if not len(a) and not len(b):
        return 1.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def fingerprint(points: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> np.ndarray:
    """The distinct chosen hashes, sorted."""
    return np.unique(winnow(points, gram, window)[0])


def written(prints: np.ndarray) -> str:
    """A fingerprint as text: eight hexadecimal digits a hash."""
    return prints.astype(">u4").tobytes().hex()


def fingerprints(documents: DataFrame, text: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Add `hashes` and `positions`, the chosen hashes in order and where they stand.

    Null and empty texts have none; a text shorter than a gram has one.
    """
    frame = documents.drop("hashes", "positions")
    names = frame.columns
    place = names.index(text)
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [winnow(_points(t.as_py()), gram, window) for t in batch.column(place)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns, pa.array([h.astype(np.int64) for h, _ in found], pa.list_(pa.int64())),
                    pa.array([p for _, p in found], pa.list_(pa.int64())),
                ],
                [*names, "hashes", "positions"],
            )

    return frame.mapInArrow(choose, f"{head}, hashes array<long>, positions array<long>")


def _points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _placed(documents: DataFrame) -> DataFrame:
    """Rows by descending id in ranges; the row that follows a range also ends it.

    Ranges are cut at ids that a sketch of the ids gives, so they hold about equally many
    rows; only ids are read for it.  `tail` marks the row borrowed from the next range.
    """
    parts = parallelism(documents.sparkSession)
    keyed = documents.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("k"), "doc_id", "text")
    ids = documents.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("k"))
    shares = [i / parts for i in range(1, parts)]
    cuts = sorted(set(ids.agg(F.percentile_approx("k", shares, 10_000)).first()[0] or [])) if parts > 1 else []
    # Range 0 holds the largest ids: one number per cut that is not below the id.
    bounds = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    bucket = F.size(F.filter(bounds, lambda c: c > F.col("k")))
    firsts = ids.select(bucket.alias("part"), "k").groupBy("part").agg(F.max("k").alias("first")).collect()
    held = sorted((r.part, r["first"]) for r in firsts)
    # The first row after the last one is the first of all.
    borrowed = {first: held[i - 1][0] for i, (_, first) in enumerate(held)}
    if not borrowed:
        return keyed.select(F.lit(0).alias("part"), F.lit(False).alias("tail"), "k", "doc_id", "text")
    lender = F.map_from_arrays(
        F.array(*[F.lit(k) for k in borrowed]).cast("array<bigint>"), F.array(*[F.lit(p) for p in borrowed.values()])
    )
    own = F.struct(bucket.alias("part"), F.lit(False).alias("tail"))
    lent = F.struct(F.try_element_at(lender, F.col("k")).alias("part"), F.lit(True).alias("tail"))
    homes = F.when(lent["part"].isNull(), F.array(own)).otherwise(F.array(own, lent))
    rows = keyed.select(F.explode(homes).alias("home"), "k", "doc_id", "text").select("home.*", "k", "doc_id", "text")
    placed = rows.repartitionById(len(held) and max(p for p, _ in held) + 1, F.col("part"))
    return placed.sortWithinPartitions("part", "tail", F.desc("k"), "text")


SIDE = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edited_fingerprints(documents: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Each document's fingerprint, its edited text's, and the likeness of neighbours.

    Documents follow each other by descending id, the first after the last; rows of equal
    id by text.  The edited text has the last third of the code points, rounded down,
    replaced by the first as many of the next document.  A null text is empty; a null id
    comes after all others.  A single row follows itself.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row whose successor is awaited: id, points, fingerprint, tail
        for batch in batches:
            out: list[dict] = []
            columns = batch.select(["tail", "doc_id", "text"])
            for tail, key, text in zip(*(c for c in columns.columns)):
                points = _points(text.as_py())
                prints = fingerprint(points, gram, window)
                if held is not None and not held[3]:
                    out.append(_row(held, points, prints))
                held = (key.as_py(), points, prints, tail.as_py())
            yield _batch(out)

    def _row(held, following, next_prints) -> dict:
        key, points, prints, _ = held
        cut = len(points) // 3
        changed = np.concatenate([points[: len(points) - cut], following[:cut]])
        edited = fingerprint(changed, gram, window)
        raw = changed.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
        return {
            "doc_id": key, "n_chars": len(points), "edited_sha256": hashlib.sha256(raw).hexdigest(),
            "fingerprint": written(prints), "edited_fingerprint": written(edited),
            "near_edited": likeness(prints, edited), "near_next": likeness(prints, next_prints),
        }

    def _batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, pa.schema([
            ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
            ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
            ("near_edited", pa.float64()), ("near_next", pa.float64()),
        ]))

    return _placed(documents).drop("part", "k").mapInArrow(compare, SIDE)
