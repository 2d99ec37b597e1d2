"""Packing documents into sequences of bounded length by sums of squares.

Documents are tokenized where they are; only lengths and checksums are moved.  Pieces are
dealt to groups, and each group is packed longest first: a piece goes where the squared
counts of open bins per residual gap become smallest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.frames import by_key, groups
from corpusloom.llm.text import LOWER, SOLID, buffers, blocks, hash_spans, row_starts, runs
from corpusloom.session import materialise

CAPACITY = 4096
END_ID = 1
# Pieces packed together.  A group leaves about one sequence unfilled, so its share of
# wasted space is bounded whatever the corpus.
GROUP_PIECES = 50_000
# Distinct words a worker remembers, some 40 bytes each; then it starts anew.
MEMO_WORDS = 3_000_000

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"

# Bytes that end no word: ASCII letters, digits, other printable ASCII.  Quotes and angle
# brackets take part in rules across letters or in special tokens, so their words are
# encoded whole.
_WHITE, _LETTER, _DIGIT, _MARK, _WHOLE = range(5)
_KIND = np.full(256, _WHOLE, dtype=np.uint8)
_KIND[0x21:0x7F] = _MARK
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x41:0x5B] = _LETTER
_KIND[0x61:0x7B] = _LETTER
_KIND[[0x27, 0x3C]] = _WHOLE
_KIND[~SOLID] = _WHITE
# Second bytes of the two-byte letters U+00C0 to U+00FF; the two that are no letters are out.
_LATIN = np.zeros(256, dtype=bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False


def segments(data: np.ndarray, off: np.ndarray):
    """Units that a word-end BPE encodes by themselves: bytes, starts, ends, whole flags.

    Between white space, a run of plain letters, a digit, or a run of other marks is a
    unit; letters are lower-cased in the returned bytes.  What holds anything else is one
    unit as it stands.
    """
    kind = _KIND[data]
    low = LOWER[data]
    if (data >= 0x80).any():
        lead = np.zeros(len(data), dtype=bool)
        lead[:-1] = (data[:-1] == 0xC3) & _LATIN[data[1:]]
        second = np.zeros(len(data), dtype=bool)
        second[1:] = lead[:-1]
        kind[lead | second] = _LETTER
        low[second & (data < 0x9F)] += 32
    odd = kind == _WHOLE
    if odd.any():
        s, e, _ = runs(kind != _WHITE, off)
        seen = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(odd, out=seen[1:])
        bad = seen[e] > seen[s]
        step = np.zeros(len(data) + 1, dtype=np.int32)
        np.add.at(step, s[bad], 1)
        np.add.at(step, e[bad], -1)
        inside = np.cumsum(step[:-1]) > 0
        kind[inside] = _WHOLE
        low[inside] = data[inside]
    first = row_starts(off, len(data))
    change = np.ones(len(data), dtype=bool)
    change[1:] = (kind[1:] != kind[:-1]) | first[1:] | (kind[1:] == _DIGIT)
    begins = np.flatnonzero(change)
    ends = np.append(begins[1:], len(data))
    solid = kind[begins] != _WHITE
    begins, ends = begins[solid], ends[solid]
    return low, begins, ends, kind[begins] == _WHOLE, np.searchsorted(begins, off)


class Encoder:
    """Token ids of whole texts, each distinct unit encoded once while remembered."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.full = Tokenizer.from_str(vocabulary)
        self.plain = Tokenizer(self.full.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])
        vocab = self.full.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, dtype=bool)
        for token, number in vocab.items():
            self.last[number] = token.endswith("</w>")
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids, self.used = np.zeros(1 << 16, np.int32), 0

    def _add(self, keys: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Remember new sorted keys; `ids` are theirs, one after the other."""
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(2 * (self.used + len(ids)), np.int32)])
        self.ids[self.used : self.used + len(ids)] = ids
        at = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)
        where = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, where, keys)
        self.at, self.size = np.insert(self.at, where, at), np.insert(self.size, where, sizes)

    def _learn(self, keys, low, s, e, whole) -> None:
        if len(self.keys) + len(keys) > MEMO_WORDS:
            self.forget()
        raw = low.tobytes()
        sizes = np.zeros(len(keys), dtype=np.int32)
        ids: list = [None] * len(keys)
        simple = np.flatnonzero(~whole)
        for a in range(0, len(simple), 2000):
            part = simple[a : a + 2000]
            text = b" ".join(raw[s[k] : e[k]] for k in part.tolist()).decode()
            found = np.array(self.plain.encode(text, add_special_tokens=False).ids, dtype=np.int32)
            ends = np.flatnonzero(self.last[found]) + 1
            if len(ends) != len(part):
                raise ValueError("the vocabulary does not mark word ends")
            for k, x, y in zip(part.tolist(), np.append(0, ends[:-1]).tolist(), ends.tolist()):
                ids[k] = found[x:y]
        for k in np.flatnonzero(whole).tolist():
            text = raw[s[k] : e[k]].decode("utf-8", "replace")
            ids[k] = np.array(self.full.encode(text, add_special_tokens=False).ids, dtype=np.int32)
        for k, found in enumerate(ids):
            sizes[k] = len(found)
        self._add(keys, sizes, np.concatenate(ids) if ids else np.zeros(0, np.int32))

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block of texts, and each text's first id."""
        low, s, e, whole, bounds = segments(data, off)
        key = hash_spans(low, s, e)
        key[whole] ^= np.uint64(0x5851F42D4C957F2D)
        distinct, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        where = np.minimum(np.searchsorted(self.keys, distinct), max(len(self.keys) - 1, 0))
        new = self.keys[where] != distinct if len(self.keys) else np.ones(len(distinct), dtype=bool)
        if new.any():
            if len(self.keys) + new.sum() > MEMO_WORDS:
                self.forget()
                new[:] = True
            pick = first[new]
            self._learn(distinct[new], low, s[pick], e[pick], whole[pick])
            where = np.searchsorted(self.keys, distinct)
        at, size = self.at[where][inverse], self.size[where][inverse].astype(np.int64)
        total = np.zeros(len(size) + 1, dtype=np.int64)
        np.cumsum(size, out=total[1:])
        spread = np.repeat(at - total[:-1], size) + np.arange(total[-1])
        return self.ids[spread], total[bounds]


_encoders: dict[int, Encoder] = {}


def encoder(shared) -> Encoder:
    """The worker's encoder of a broadcast vocabulary."""
    if shared.id not in _encoders:
        _encoders.clear()
        _encoders[shared.id] = Encoder(shared.value)
    return _encoders[shared.id]


class _Shared:
    """A broadcast with an id that workers know it by."""

    def __init__(self, broadcast, name: int):
        self.broadcast, self.id = broadcast, name

    @property
    def value(self):
        return self.broadcast.value


def broadcast_vocabulary(spark, path: str) -> _Shared:
    """The tokenizer file, a few MB, read once by the driver."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    return _Shared(spark.sparkContext.broadcast(text), zlib.crc32(text.encode()))


def tokenized_pieces(
    documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """One row per piece: `doc_id, piece, start, length, ids_crc32`.

    A document is its text's ids and then `end_id`; only a longer one than `capacity` is
    cut, and only its last piece may be shorter.  A null text is empty and so one id.
    """
    shared = broadcast_vocabulary(documents.sparkSession, tokenizer)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(shared)
        for batch in batches:
            data, off = buffers(batch.column(1))
            keys = batch.column(0)
            rows, pieces, starts, lengths, sums = [], [], [], [], []
            for a, b in blocks(off, 1 << 19):
                part = off[a : b + 1]
                ids, bounds = known.encode(data[part[0] : part[-1]], part - part[0])
                ids = ids.astype("<u4")
                last = np.array([end_id], dtype="<u4").tobytes()
                for r, (x, y) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    raw = ids[x:y].tobytes() + last
                    size = y - x + 1
                    for k in range(-(-size // capacity)):
                        start = k * capacity
                        rows.append(a + r)
                        pieces.append(k)
                        starts.append(start)
                        lengths.append(min(capacity, size - start))
                        sums.append(zlib.crc32(raw[4 * start : 4 * (start + capacity)]))
            yield pa.RecordBatch.from_arrays(
                [
                    keys.take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()), pa.array(sums, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return documents.select("doc_id", "text").mapInArrow(cut, PIECE)


def pack_lengths(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, taken in the given order.

    Of the open bins with room and a new bin, the one that leaves the smallest sum of
    squared counts of open bins per gap is used; of equals the one left with the
    smallest gap.  Full bins have no gap and do not count.
    """
    count = np.zeros(capacity + 1, dtype=np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    made = 0
    for at, size in enumerate(lengths.tolist()):
        # Gap g becomes g - size: the sum changes by 2 (N[g-size] - N[g]) + 2, and by
        # 1 - 2 N[g] when the bin is filled; a new bin adds 2 N[capacity-size] + 1.
        have = np.flatnonzero(count[size:capacity]) + size
        best, gap = (2 * count[capacity - size] + 1 if size < capacity else 0), capacity
        if len(have):
            after = have - size
            change = 2 * (count[after] - count[have]) + 2
            if have[0] == size:
                change[0] = 1 - 2 * count[size]
            k = int(change.argmin())
            if change[k] <= best:
                gap = int(have[k])
        if gap == capacity:
            where = made
            made += 1
        else:
            where = open_bins[gap].pop()
            count[gap] -= 1
        bins[at], offsets[at] = where, capacity - gap
        if gap > size:
            open_bins[gap - size].append(where)
            count[gap - size] += 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add `sequence_id` and `offset` to rows with `doc_id`, `piece` and `length`.

    `pieces` is read twice and should be a written table.
    """
    count = pieces.count()
    parts = max(1, -(-count // group_pieces))
    spread = F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(parts)).cast("int")
    grouped = by_key(pieces.withColumn("_group", spread).withColumn("_minus", -F.col("length")), "_group",
                     then=("_minus", "doc_id", "piece"))
    names = pieces.columns
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, "_group"):
            bins, offsets = pack_lengths(table.column("length").to_numpy(), capacity)
            group = table.column("_group")[0].as_py()
            out = table.select(names).append_column("sequence_id", pa.array(bins + (group << 32)))
            yield from out.append_column("offset", pa.array(offsets)).combine_chunks().to_batches()

    return grouped.mapInArrow(place, f"{head}, sequence_id long, offset long")


def pack_documents(
    documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Per piece: `doc_id, piece, start, length, ids_crc32, sequence_id, offset`.

    Offsets in a sequence are gapless from 0.  Rows with a null or repeated id are packed
    like all others.  An empty table gives no rows.
    """
    pieces = materialise(tokenized_pieces(documents, tokenizer, capacity, end_id), "pieces")
    return pack(pieces, capacity)
