r"""Text cleaning as native column expressions.

The rule is: null to empty, drop every character that is neither a word character nor
whitespace (Unicode sense, underscore kept), lowercase, collapse whitespace runs to one
space, strip the ends.  A plain `\w` will not do, since the JVM reads it as ASCII, and
its Unicode mode keeps combining marks and loses characters such as `½`.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.schemas import MIN_CHARS

# Every Unicode whitespace character, as code point ranges.
WHITESPACE = (
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
    (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
    (0x3000, 0x3000),
)

# Letters and digits of Unicode 14 to 15.1 that a Java 17 runtime does not
# know yet; harmless on a newer one.
NEWER_LETTERS = (
    (0x870, 0x887), (0x889, 0x88E), (0x8B5, 0x8B5), (0x8C8, 0x8C9), (0xC5D, 0xC5D),
    (0xCDD, 0xCDD), (0x170D, 0x170D), (0x171F, 0x171F), (0x1B4C, 0x1B4C),
    (0x2C2F, 0x2C2F), (0x2C5F, 0x2C5F), (0x9FFD, 0x9FFF), (0xA7C0, 0xA7C1),
    (0xA7D0, 0xA7D1), (0xA7D3, 0xA7D3), (0xA7D5, 0xA7D9), (0xA7F2, 0xA7F4),
    (0x10570, 0x1057A), (0x1057C, 0x1058A), (0x1058C, 0x10592), (0x10594, 0x10595),
    (0x10597, 0x105A1), (0x105A3, 0x105B1), (0x105B3, 0x105B9), (0x105BB, 0x105BC),
    (0x10780, 0x10785), (0x10787, 0x107B0), (0x107B2, 0x107BA), (0x10F70, 0x10F81),
    (0x11071, 0x11072), (0x11075, 0x11075), (0x1123F, 0x11240), (0x11740, 0x11746),
    (0x11AB0, 0x11ABF), (0x11F02, 0x11F02), (0x11F04, 0x11F10), (0x11F12, 0x11F33),
    (0x11F50, 0x11F59), (0x12F90, 0x12FF0), (0x1342F, 0x1342F), (0x13441, 0x13446),
    (0x16A70, 0x16ABE), (0x16AC0, 0x16AC9), (0x1AFF0, 0x1AFF3), (0x1AFF5, 0x1AFFB),
    (0x1AFFD, 0x1AFFE), (0x1B11F, 0x1B122), (0x1B132, 0x1B132), (0x1B155, 0x1B155),
    (0x1D2C0, 0x1D2D3), (0x1DF00, 0x1DF1E), (0x1DF25, 0x1DF2A), (0x1E030, 0x1E06D),
    (0x1E290, 0x1E2AD), (0x1E4D0, 0x1E4EB), (0x1E4F0, 0x1E4F9), (0x1E7E0, 0x1E7E6),
    (0x1E7E8, 0x1E7EB), (0x1E7ED, 0x1E7EE), (0x1E7F0, 0x1E7FE), (0x2A6DE, 0x2A6DF),
    (0x2B735, 0x2B739), (0x2EBF0, 0x2EE5D), (0x31350, 0x323AF),
)


def _regex_ranges(ranges) -> str:
    return "".join(
        rf"\x{{{a:x}}}" if a == b else rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in ranges
    )


_SPACES = [chr(c) for a, b in WHITESPACE for c in range(a, b + 1)]
_OTHER_SPACES = "".join(c for c in _SPACES if c != " ")
_ASCII_MARKS = string.punctuation.replace("_", "")
_SPACE_CLASS = _regex_ranges(WHITESPACE)


def _outside(kept: str) -> str:
    """Runs of characters outside `kept` that are no newer letters either.

    The long list stands in an intersection, so it is only looked up for characters the
    short class rejects; as one class it would cost five times as much.
    """
    return rf"[[^{kept}\p{{L}}\p{{N}}]&&[^{_regex_ranges(NEWER_LETTERS)}]]+"


def strip_marks(text: Column) -> Column:
    """Remove all characters that are neither word characters nor whitespace."""
    return F.regexp_replace(text, _outside(f"_{_SPACE_CLASS}"), "")


def clean(text: Column) -> Column:
    """The whole cleaning rule.

    `translate` drops ASCII marks and maps every other whitespace to a plain space in one
    table-driven pass, so the regular expressions only have other marks, control
    characters and runs of plain spaces left to look for.
    """
    spaced = F.translate(
        F.coalesce(text, F.lit("")), _OTHER_SPACES + _ASCII_MARKS, " " * len(_OTHER_SPACES)
    )
    kept = F.regexp_replace(spaced, _outside(" -~"), "")
    return F.trim(F.regexp_replace(F.lower(kept), "  +", " "))


def with_clean_text(df: DataFrame, column: str = "text") -> DataFrame:
    """Replace `column` by its cleaned form, keeping every row."""
    return df.withColumn(column, clean(F.col(column)))


def clean_and_filter(df: DataFrame, min_chars: int = MIN_CHARS, column: str = "text") -> DataFrame:
    """Clean `column` and keep rows with at least `min_chars` characters left.

    Written as `withColumn` + `filter`, predicate pushdown copies the cleaning below the
    projection and every text is cleaned twice.  A generator over the one cleaned value is
    a barrier for that rewrite: one cleaning per row, no shuffle, still one code stage.
    """
    others = [c for c in df.columns if c != column]
    cleaned = df.select(*others, F.explode(F.array(clean(F.col(column)))).alias(column))
    return cleaned.filter(F.length(column) >= min_chars).select(*df.columns)


def min_length(df: DataFrame, min_chars: int = MIN_CHARS, column: str = "text") -> DataFrame:
    """Keep rows whose `column` as it stands has at least `min_chars` characters."""
    return df.filter(F.length(column) >= min_chars)
