"""Benchmark decontamination: Wu-Manber search for item windows in whole texts.

Windows of consecutive item words are the patterns.  The search looks at blocks of two
words: a shift table says how far the window can move without passing an occurrence, and
where it says zero, the hash of the window's last block picks the patterns that may end
there, which are then compared word by word.  All segments of a batch advance together.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.text import ALNUM, blocks, buffers, mix, words
from corpusloom.session import materialise

WINDOW = 10
# Item words searched for in one pass, so that the broadcast tables are at most 100 MB; more
# items take more passes.
PASS_WORDS = 1_000_000
# The shift table has this many bits of a block's hash.
_SHIFT_BITS = 20
# Texts are cut into segments of this many windows, which advance side by side.
_SEGMENT = 256

FOUND = "n_words long, spans array<struct<start:long,end:long>>, items array<string>"
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Patterns:
    """The windows of one length: their words, items, shift table and suffix buckets."""

    def __init__(self, length: int, windows: np.ndarray, items: list[set]):
        self.length, self.block = length, min(2, length)
        suffix = self.blocks_at(windows, length)
        order = np.argsort(suffix, kind="stable")
        self.windows, self.suffix = windows[order], suffix[order]
        self.items = [sorted(items[k]) for k in order.tolist()]
        most = length - self.block + 1
        self.shift = np.full(1 << _SHIFT_BITS, most, dtype=np.int16)
        for end in range(self.block, length + 1):
            np.minimum.at(self.shift, self.place(self.blocks_at(windows, end)), length - end)

    def blocks_at(self, windows: np.ndarray, end: int) -> np.ndarray:
        last = windows[:, end - 1]
        return block_hash(windows[:, end - 2], last) if self.block == 2 else last

    @staticmethod
    def place(block: np.ndarray) -> np.ndarray:
        return (block >> np.uint64(64 - _SHIFT_BITS)).astype(np.int64)


def block_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * _FACTOR + second)


def build_patterns(ids: list[str], texts: pa.Array, window: int) -> list[Patterns]:
    """Distinct windows by length, each with the items it comes from."""
    data, off = buffers(texts)
    _, _, _, hashes, bounds = words(data, off, ALNUM)
    found: dict[int, dict[bytes, set]] = {}
    for item, a, b in zip(ids, bounds[:-1].tolist(), bounds[1:].tolist()):
        if b == a:
            continue
        length = min(window, b - a)
        same = found.setdefault(length, {})
        for k in range(a, b - length + 1):
            owners = same.setdefault(hashes[k : k + length].tobytes(), set())
            if item is not None:
                owners.add(item)
    return [
        Patterns(n, np.frombuffer(b"".join(same), np.uint64).reshape(-1, n), list(same.values()))
        for n, same in sorted(found.items())
    ]


def search(hashes: np.ndarray, bounds: np.ndarray, p: Patterns) -> tuple[np.ndarray, np.ndarray]:
    """First word and pattern number of every occurrence within a row."""
    m = p.length
    windows = np.maximum(np.diff(bounds) - m + 1, 0)
    pieces = -(-windows // _SEGMENT)
    row = np.repeat(np.arange(len(windows)), pieces)
    at = (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * _SEGMENT
    cursor = bounds[:-1][row] + at + m - 1
    stop = bounds[:-1][row] + np.minimum(at + _SEGMENT, windows[row]) + m - 1
    ends = []
    while len(cursor):
        last = hashes[cursor]
        block = block_hash(hashes[cursor - 1], last) if p.block == 2 else last
        step = p.shift[p.place(block)].astype(np.int64)
        zero = step == 0
        if zero.any():
            ends.append((cursor[zero], block[zero]))
            step[zero] = 1
        cursor = cursor + step
        left = cursor < stop
        cursor, stop = cursor[left], stop[left]
    if not ends:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    end = np.concatenate([e for e, _ in ends])
    block = np.concatenate([b for _, b in ends])
    low, high = np.searchsorted(p.suffix, block, "left"), np.searchsorted(p.suffix, block, "right")
    count = high - low
    start = np.repeat(end - m + 1, count)
    which = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
    for k in range(m):
        same = hashes[start + k] == p.windows[which, k]
        start, which = start[same], which[same]
    return start, which


def merged(spans: np.ndarray) -> np.ndarray:
    """Sorted, disjoint spans with the same words."""
    if len(spans) < 2:
        return spans
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.r_[True, spans[1:, 0] > reach[:-1]]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(spans) - 1)
    return np.stack([spans[new, 0], reach[last]], axis=1)


def scan(documents: DataFrame, patterns: list[Patterns], text: str = "text") -> DataFrame:
    """Add `n_words`, the hit word `spans` and the `items` found."""
    shared = documents.sparkSession.sparkContext.broadcast(patterns)
    names = documents.columns
    place = names.index(text)
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(place))
            counts = np.zeros(batch.num_rows, dtype=np.int64)
            spans: list[list] = [[] for _ in range(batch.num_rows)]
            items: list[list] = [[] for _ in range(batch.num_rows)]
            for a, b in blocks(off):
                part = off[a : b + 1]
                _, _, _, hashes, bounds = words(data[part[0] : part[-1]], part - part[0], ALNUM)
                counts[a:b] = np.diff(bounds)
                hits: dict[int, list] = {}
                for p in shared.value:
                    start, which = search(hashes, bounds, p)
                    rows = np.searchsorted(bounds, start, "right") - 1
                    for r, s, w in zip(rows.tolist(), start.tolist(), which.tolist()):
                        hits.setdefault(r, []).append((s - int(bounds[r]), p.length, p.items[w]))
                for r, found in hits.items():
                    cut = merged(np.array([(s, s + n) for s, n, _ in found]))
                    spans[a + r] = [{"start": int(x), "end": int(y)} for x, y in cut]
                    items[a + r] = sorted({i for _, _, owners in found for i in owners})
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(counts), pa.array(spans, span), pa.array(items, pa.list_(pa.string()))],
                [*names, "n_words", "spans", "items"],
            )

    return documents.mapInArrow(find, f"{head}, {FOUND}")


def _item_pieces(benchmark: DataFrame, window: int) -> DataFrame:
    """Items as `(item_id, text)` pieces that together have all windows of each item.

    An item longer than a tenth of a pass is cut at its words, pieces overlapping by a
    window less one word.
    """
    most = PASS_WORDS // 10
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").filter("text is not null")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    parts = F.regexp_extract_all(lowered, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))
    cut = items.select("item_id", parts.alias("w")).filter("size(w) > 0")
    starts = F.sequence(F.lit(0), F.floor(F.greatest(F.size("w") - window, F.lit(0)) / most).cast("int"))
    return cut.select("item_id", "w", F.explode(starts).alias("k")).select(
        "item_id", F.concat_ws(" ", F.slice("w", F.col("k") * most + 1, most + window - 1)).alias("text"),
        F.least(F.size("w") - F.col("k") * most, F.lit(most + window - 1)).alias("n"),
    )


def find_passages(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """`documents` with `n_words`, `spans` and `items`.

    Words are runs of digits, letters and non-ASCII characters, A to Z lower-cased.  A
    window is `window` consecutive item words; an item of fewer words, but not none, is
    one window.  `spans` are the half-open ranges of words inside any occurrence, merged;
    `items` are the ids, as sorted strings, of the items with an occurring window.  Null
    texts have no words; a null item id hits words but is not listed; repeated items count
    once.  Columns of these three names are replaced.

    The items of one pass are at most about `PASS_WORDS` words; more items take more
    passes over the documents, whose findings are merged per row.
    """
    documents = documents.drop("n_words", "spans", "items")
    pieces = _item_pieces(benchmark, window).distinct()
    total = pieces.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    passes = max(1, -(-int(total) // (PASS_WORDS // 2)))
    if passes == 1:
        return scan(documents, _collect(pieces, window))
    # Several passes: findings by pass, keyed by the row's content, copies counted.
    pieces = materialise(pieces, "items")
    content = F.xxhash64(*[c for c, kind in documents.dtypes if not kind.startswith("map")])
    keyed = documents.withColumn("_row", content)
    found = []
    for k in range(passes):
        mine = pieces.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k)
        rows = scan(keyed.select("_row", "text"), _collect(mine, window)).filter("size(spans) > 0")
        found.append(materialise(rows.select("_row", "spans", "items").dropDuplicates(["_row"]), "pass"))
    merged_rows = reduce(DataFrame.unionByName, found).groupBy("_row").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    counted = scan(keyed, []).drop("spans", "items")
    joined = counted.join(merged_rows, "_row", "left").drop("_row")
    empty_spans = F.array().cast("array<struct<start:long,end:long>>")
    return joined.withColumn("spans", merge_spans(F.coalesce("spans", empty_spans))).withColumn(
        "items", F.coalesce("items", F.array().cast("array<string>"))
    )


def merge_spans(spans):
    """Disjoint spans with the same words, in order."""
    empty = F.array().cast("array<struct<start:long,end:long>>")

    def add(done, span):
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        more = F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))
        return F.when(last.isNotNull() & (span["start"] <= last["end"]), more).otherwise(
            F.concat(done, F.array(span))
        )

    return F.aggregate(F.array_sort(spans), empty, add)


def _collect(pieces: DataFrame, window: int) -> list[Patterns]:
    """One pass's patterns; the pieces were counted to fit."""
    table = pieces.select("item_id", "text").toArrow().combine_chunks()
    if not table.num_rows:
        return []
    column = table.column("text").combine_chunks()
    return build_patterns(table.column("item_id").to_pylist(), column, window)


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: `n_words`, `n_hit`, `n_items`, `items_sha256` and `contaminated`."""
    found = find_passages(documents.select("doc_id", "text"), benchmark, window)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )
