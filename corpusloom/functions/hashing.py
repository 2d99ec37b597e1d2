"""Uniform numbers from row keys.

A row's number depends on its key and the seed alone, so order, splits and samples stay
the same for any partitioning, file layout or task retry.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from corpusloom.schemas import SEED


def key_uniform(key: Column, seed: int = SEED, word: int = 0) -> Column:
    """A number in [0, 1) from 32 bits of `md5("<seed>:<key>")`; `word` 0 to 3 picks the
    bits, so one key yields four independent numbers."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    bits = F.conv(F.substring(digest, 8 * word + 1, 8), 16, 10)
    return bits.cast("double") / F.lit(float(2**32))


def order_uniform(key: Column, seed: int = SEED) -> Column:
    """The number that orders, splits and samples rows."""
    return key_uniform(key, seed, 0)


def file_number(key: Column, files: int, seed: int = SEED) -> Column:
    """File 0 to `files` - 1 of a row, independent of its split and order number."""
    return F.floor(key_uniform(key, seed, 1) * files).cast("int")
