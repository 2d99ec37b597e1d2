"""Pieces by the trie against the plain search from the left."""

import random

import numpy as np
import pytest

from corpusloom.functions.trie import PieceTrie
from corpusloom.functions.wordpiece import split_or_unknown, split_word


def words_of(rng, letters, longest):
    return "".join(rng.choice(letters) for _ in range(rng.randint(0, longest)))


@pytest.mark.parametrize("letters", ["ab", "abc#", "aé日\U0001f600"])
@pytest.mark.parametrize("seed", range(40))
def test_split_equals_the_plain_search(letters, seed):
    rng = random.Random(seed)
    pieces = {rng.choice(["", "##"]) + words_of(rng, letters, 6) for _ in range(rng.randint(0, 25))}
    tokens = sorted(pieces - {""})
    known = {t: i for i, t in enumerate(tokens)}
    words = [words_of(rng, letters, 14) for _ in range(60)]
    ids, sizes, split = PieceTrie(tokens, np.arange(len(tokens))).split(words, 12)
    ends = np.cumsum(sizes)
    for word, end, size, is_split in zip(words, ends, sizes, split):
        wanted = split_word(word, known) if len(word) <= 12 else None
        assert (is_split, [tokens[i] for i in ids[end - size : end]]) == (wanted is not None, wanted or [])


def test_unknown_words_have_one_unknown_piece():
    trie = PieceTrie(["a", "##b"], np.array([7, 9]))
    found, sizes = split_or_unknown(trie, ["b", "ab", "", "ax", "abb", "a" * 101], 100)
    assert found.tolist() == [100, 7, 9, 100, 100, 7, 9, 9, 100] and sizes.tolist() == [1, 2, 1, 1, 3, 1]
    assert split_or_unknown(PieceTrie([], np.zeros(0)), ["a", ""], 100)[0].tolist() == [100, 100]
    assert split_or_unknown(trie, [], 100)[0].tolist() == []


def test_long_pieces_are_walked_once():
    # Without failure links each start would read the whole rest: 5,000 characters squared.
    trie = PieceTrie(["a" * 5000, "a", "##a"], np.arange(3))
    ids, sizes, split = trie.split(["a" * 4999 + "b", "a" * 4999, "a" * 5000], 10_000)
    assert split.tolist() == [False, True, True] and sizes.tolist() == [0, 4999, 1]
