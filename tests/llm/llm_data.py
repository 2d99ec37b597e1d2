"""Invented documents that the tests of this folder share."""

import random

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, count: int) -> list[str]:
    rng = random.Random(seed)
    parts = ["an", "the", "tion", "re", "ou", "er", "st", "in", "ha", "ly"]
    return ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(count)]


def text_of(seed: int, count: int) -> str:
    """Invented prose in sentences of about eight words."""
    out = []
    for k, word in enumerate(words(seed, count)):
        word = word.capitalize() if k % 8 == 0 else word
        out.append(word + ("." if k % 8 == 7 else ""))
    return " ".join(out)


def edge_rows() -> list[tuple]:
    """Nulls in every column, empty and white texts, a long one, repeated rows, odd bytes."""
    long = text_of(99, 6000)
    return [
        (None, "No id here at all", "en", None, None), (1, None, None, "a", None), (2, "", "en", "a", 0),
        (3, " \t\n ", "en", "a", 4), (4, long, "en", "b", len(long)), (5, "one", "en", "b", 3),
        (5, "one", "en", "b", 3), (6, "ÉTÉ été 12 !? 日本語 \U0001f600", "fr", "b", 5), (7, "x" * 5000, "en", "b", 5000),
        (8, "the the the the the the the the the the", "en", "b", 9), (9, "no'break <|endoftext|> a b it's", "en", None, 1),
    ]
