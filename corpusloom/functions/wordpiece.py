"""Greedy longest-match word pieces over a broadcast vocabulary."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from corpusloom.functions.encode import fill_rows, gather_rows, row_lengths, row_slices
from corpusloom.functions.trie import PieceTrie
from corpusloom.operators.vocab import MAX_WORD_CHARS
from corpusloom.schemas import ENCODING, UNK

# Code point ranges whose characters are words of their own.
IDEOGRAPHS = (
    (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2A6DF),
    (0x2A700, 0x2B73F), (0x2B740, 0x2B81F), (0x2B820, 0x2CEAF), (0x2F800, 0x2FA1F),
)
# Distinct words split at once.
SPLIT_WORDS = 16_384


def spread_marks(text: Column) -> Column:
    """Set underscores and ideographs of a cleaned text apart as words, the way an uncased
    pretrained tokenizer sees them."""
    ranges = "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in IDEOGRAPHS)
    spaced = F.regexp_replace(text, f"([_{ranges}])", " $1 ")
    return F.trim(F.regexp_replace(spaced, "  +", " "))


def without_accents(word: str) -> str:
    split = unicodedata.normalize("NFD", word)
    return "".join(c for c in split if unicodedata.category(c) != "Mn")


def accent_stripper():
    """Arrow function from words to words without accents."""

    @F.arrow_udf("string")
    def strip(words: pa.Array) -> pa.Array:
        return pa.array([without_accents(w) for w in words.to_pylist()], pa.string())

    return strip


def split_word(word: str, known) -> list[str] | None:
    """Longest known pieces from the left, or None if some part has no piece."""
    if len(word) > MAX_WORD_CHARS:
        return None
    pieces, start = [], 0
    while start < len(word):
        mark = "##" if start else ""
        for end in range(len(word), start, -1):
            piece = mark + word[start:end]
            if piece in known:
                pieces.append(piece)
                start = end
                break
        else:
            return None
    return pieces


def split_or_unknown(trie: PieceTrie, words: list[str], unknown: int) -> tuple[np.ndarray, np.ndarray]:
    """The values of all words' pieces and how many each word has; at least one."""
    found, sizes, known = trie.split(words, MAX_WORD_CHARS)
    lost = ~known | (sizes == 0)
    starts = np.cumsum(sizes) - sizes
    return np.insert(found, starts[lost], unknown), np.where(lost, 1, sizes)


def piece_splitter(vocabulary):
    """Arrow function from words to piece arrays; an unsplittable word gives `[UNK]`."""

    @F.arrow_udf("array<string>")
    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = vocabulary.value[0]
        # The trie gives places in the token array; the one after its end is the unknown word.
        named = pa.concat_arrays([tokens, pa.array(["[UNK]"], tokens.type)])
        trie = PieceTrie(tokens.to_pylist(), np.arange(len(tokens)))
        for words in batches:
            found, sizes = split_or_unknown(trie, words.to_pylist(), len(tokens))
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            yield pa.ListArray.from_arrays(ends, named.take(pa.array(found)).cast(pa.string()))

    return pieces


def split_distinct(trie: PieceTrie, words: pa.Array, strip_accents: bool) -> tuple[np.ndarray, np.ndarray]:
    """`split_or_unknown` of an array of distinct words, some after the other."""
    found, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for start in range(0, len(words), SPLIT_WORDS):
        part = words.slice(start, SPLIT_WORDS).to_pylist()
        if strip_accents:
            part = [w if w.isascii() else without_accents(w) for w in part]
        ids, counts = split_or_unknown(trie, part, UNK)
        found.append(ids.astype(np.int32))
        sizes.append(counts)
    return np.concatenate(found), np.concatenate(sizes)


def piece_encoder(vocabulary, max_length: int, strip_accents: bool = False):
    """Arrow function from word arrays to encodings by word pieces.

    Each batch splits its distinct words by a trie that is kept for the task; the ids are
    then gathered in bulk, a slice of rows at a time.  A word has at least one piece, so the
    leading words always suffice.
    """
    room = max_length - 2

    @F.arrow_udf(ENCODING)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens, ids = vocabulary.value
        trie = PieceTrie(tokens.to_pylist(), ids)
        for words in batches:
            coded = pc.dictionary_encode(words.flatten())
            pool, sizes = split_distinct(trie, coded.dictionary, strip_accents)
            for word, lengths in row_slices(coded.indices.to_numpy(zero_copy_only=False), row_lengths(words)):
                yield fill_rows(*gather_rows(word, lengths, pool, sizes, room), max_length)

    return encode
