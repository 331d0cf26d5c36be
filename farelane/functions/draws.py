"""Reproducible random numbers.

``rand`` depends on how rows are spread over tasks, so a lost executor could
change them. These draws depend on the row's key only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Draws lie in [0, DRAW_RANGE).
DRAW_RANGE = 1 << 52


def hash_draw(*key: Column | str, seed: int = 42) -> Column:
    """The fast draw: one 64-bit hash of the key."""
    return F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(DRAW_RANGE))


def digest_draw(*key: Column | str, seed: int = 42) -> Column:
    """The same kind of draw from MD5, which every SQL engine can repeat."""
    text = F.concat_ws("-", *key, F.lit(seed))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def pick_index(draw: Column, size: Column | int) -> Column:
    """A place in 0..size-1."""
    return F.pmod(draw, size if isinstance(size, Column) else F.lit(size))


def rating(draw: Column) -> Column:
    """1.0 to 5.0 with one decimal."""
    share = draw / F.lit(DRAW_RANGE)
    return F.least(F.round(share * 5, 1) + 1, F.lit(5.0))
