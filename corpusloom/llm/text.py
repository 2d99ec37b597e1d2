"""Words, code points and hashes of whole Arrow batches, in numpy.

Texts are taken from the Arrow buffers as they are, so no Python object is made per word.
A word hash depends on the word's bytes alone: equal words have equal hashes in any
batch, task or session.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are worked on in blocks of about this many bytes; a longer text is its own block.
BLOCK_BYTES = 1 << 18

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def lower_ascii() -> np.ndarray:
    """Byte table that lower-cases A to Z and leaves every other byte alone."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = lower_ascii()

# Bytes of a word between white space, and of a word of letters, digits and non-ASCII.
SOLID = np.ones(256, dtype=bool)
SOLID[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, dtype=bool)
for _low, _high in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
    ALNUM[_low:_high] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def numbers(count: int, seed: int) -> np.ndarray:
    """Fixed pseudo-random 64-bit numbers."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed))


# One 64-bit value per byte.
_BYTE = numbers(256, 7)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the hash base and of its inverse; kept for the worker."""
    if len(_powers[0]) < count:
        size = 1 << (count - 1).bit_length()
        for at, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[at] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null is an empty text."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def blocks(off: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes, at least one row each."""
    at, rows = 0, len(off) - 1
    while at < rows:
        end = int(np.searchsorted(off, off[at] + limit, "right")) - 1
        end = min(rows, max(at + 1, end))
        yield at, end
        at = end


def row_starts(off: np.ndarray, size: int) -> np.ndarray:
    """Marks the first byte of each row that is not empty."""
    first = np.zeros(size, dtype=bool)
    first[off[:-1][off[:-1] < size]] = True
    return first


def runs(mask: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of `mask` within rows, and each row's first run."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    first = row_starts(off, len(mask))
    start, end = mask.copy(), mask.copy()
    cut = first[1:]
    start[1:] &= ~mask[:-1] | cut
    end[:-1] &= ~mask[1:] | cut
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(s, off)


def hash_spans(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans are in order and do not overlap."""
    out = np.empty(len(s), dtype=np.uint64)
    at = 0
    while at < len(s):
        end = max(at + 1, int(np.searchsorted(e, s[at] + BLOCK_BYTES, "right")))
        base, size = int(s[at]), int(e[end - 1] - s[at])
        power, inverse = powers(size + 1)
        total = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data[base : base + size]] * power[:size], out=total[1:])
        low, high = s[at:end] - base, e[at:end] - base
        out[at:end] = (total[high] - total[low]) * inverse[low] + (high - low).astype(np.uint64)
        at = end
    return mix(out)


def words(data: np.ndarray, off: np.ndarray, kind: np.ndarray):
    """Lower-cased bytes, word starts and ends, word hashes, and each row's first word."""
    low = LOWER[data]
    s, e, bounds = runs(kind[low], off)
    return low, s, e, hash_spans(low, s, e), bounds


def shingle_sets(hashes: np.ndarray, bounds: np.ndarray, size: int) -> list[np.ndarray]:
    """Each row's distinct shingles of `size` consecutive words, as sorted hashes.

    A row with fewer words has its whole sequence as one shingle, and none without words.
    """
    sets = []
    if len(hashes) >= size:
        rolled = hashes[: len(hashes) - size + 1].copy()
        factor = np.uint64(_BASE | 1)
        for k in range(1, size):
            rolled = rolled * factor + hashes[k : len(hashes) - size + 1 + k]
        rolled = mix(rolled)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= size:
            sets.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            whole = np.uint64(0)
            for h in hashes[a:b]:
                whole = np.uint64((int(whole) * (_BASE | 1) + int(h)) & 0xFFFFFFFFFFFFFFFF)
            # Set apart from full shingles by the word count.
            sets.append(mix(np.array([whole], np.uint64) + np.uint64(b - a)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def binary_array(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())
