"""A uniform split number from a text key."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

CRC32_MAX = 2**32 - 1


def crc32_split(key: Column, splits: int) -> Column:
    """Which of ``splits`` equal CRC32 ranges a key falls in (0-based)."""
    return F.shiftright(F.crc32(key) * F.lit(splits), 32).cast("int")


def split_bounds(split: int, splits: int) -> tuple[int, int]:
    """First and last CRC32 value of a split; those of all splits cover every value once."""
    if not 0 <= split < splits:
        raise ValueError(f"split {split} of {splits}")
    first = -(-(split << 32) // splits)
    return first, -(-((split + 1) << 32) // splits) - 1
