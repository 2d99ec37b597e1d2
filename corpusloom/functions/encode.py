"""Fixed-length id and mask arrays by whole-word lookup, row by row.

The lookup is an Arrow function over a broadcast vocabulary: no shuffle, no key needed,
and every batch is looked up in one vectorised call.  `operators.encode` picks between it
and the join form by the vocabulary's measured size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from corpusloom.schemas import CLS, ENCODING, PAD, SEP, UNK

# Rows filled at once: what a task holds does not grow with the rows that Spark hands over.
SLICE_ROWS = 512


def leading_words(text: Column, max_length: int) -> Column:
    """The words of a cleaned text that fit between the two end marks.

    The split stops after that many words, so a long text is not cut up whole.
    """
    room = max_length - 2
    fitting = F.slice(F.split(text, " ", room + 1), 1, room)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(fitting)


def pad(ids: Column, max_length: int) -> Column:
    """Id array filled up to `max_length`."""
    return F.concat(ids, F.array_repeat(F.lit(PAD), F.lit(max_length) - F.size(ids)))


def attention_mask(real: Column, max_length: int) -> Column:
    """Ones for `real` leading places, zeros for the padding."""
    return F.concat(
        F.array_repeat(F.lit(1), real), F.array_repeat(F.lit(0), F.lit(max_length) - real)
    )


def fill_rows(ids: np.ndarray, lengths: np.ndarray, max_length: int) -> pa.Array:
    """Encoding structs of rows whose ids lie one after another in `ids`.

    `lengths` counts each row's ids, at most `max_length` - 2.
    """
    rows = len(lengths)
    place = np.arange(max_length)
    filled = np.full((rows, max_length), PAD, dtype=np.int32)
    filled[(place >= 1) & (place <= lengths[:, None])] = ids
    filled[:, 0] = CLS
    filled[np.arange(rows), lengths + 1] = SEP
    mask = (place < lengths[:, None] + 2).astype(np.int32)
    starts = pa.array(np.arange(rows + 1, dtype=np.int32) * max_length)
    return pa.StructArray.from_arrays(
        [pa.ListArray.from_arrays(starts, pa.array(a.ravel())) for a in (filled, mask)],
        ["input_ids", "attention_mask"],
    )


def row_lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)


def row_slices(places: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The places of the words, and the words of each row, for a few rows after the other."""
    ends = np.concatenate([[0], np.cumsum(lengths)])
    for start in range(0, len(lengths), SLICE_ROWS):
        part = lengths[start : start + SLICE_ROWS]
        yield places[ends[start] : ends[start + len(part)]], part


def gather_rows(
    word: np.ndarray, lengths: np.ndarray, pool: np.ndarray, sizes: np.ndarray, room: int
) -> tuple[np.ndarray, np.ndarray]:
    """The ids of rows one after another, the first `room` of each, and how many each has.

    `word` numbers the words of all rows, `lengths` counts each row's words; the ids of word
    0, 1, ... lie one after another in `pool`, `sizes` of each.
    """
    # Per word in order: its row, and the place of its first id in that row.
    rows = len(lengths)
    row = np.repeat(np.arange(rows), lengths)
    size = sizes[word]
    total = np.cumsum(size) if len(word) else np.zeros(0, np.int64)
    row_total = np.bincount(row, weights=size, minlength=rows).astype(np.int64)
    before_row = np.cumsum(row_total) - row_total

    # Per id: where it is in the pool, and its place in its row.
    starts = np.cumsum(sizes) - sizes
    within = np.arange(int(row_total.sum())) - np.repeat(total - size, size)
    source = np.repeat(starts[word], size) + within
    place = np.arange(len(within)) - np.repeat(before_row, row_total)
    return pool[source[place < room]], np.minimum(row_total, room)


def word_encoder(vocabulary, max_length: int):
    """Arrow function from word arrays to encodings; `vocabulary` is a broadcast of
    (token array, id array)."""

    @F.arrow_udf(ENCODING)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens, ids = vocabulary.value
        id_at = np.append(ids, np.int32(UNK))
        for words in batches:
            found = pc.fill_null(pc.index_in(words.flatten(), value_set=tokens), len(ids))
            for places, lengths in row_slices(found.to_numpy(zero_copy_only=False), row_lengths(words)):
                yield fill_rows(id_at[places], lengths, max_length)

    return encode
