"""Keyed hashes: the same row gets the same draw whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(key: Column, seed: int) -> Column:
    """Uniform 128-bit draw as 32 hex digits, ordered as text."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))


def below(hex_draw: Column, fraction: float) -> Column:
    """True for `fraction` of all draws, judged by the leading 32 bits."""
    if fraction >= 1:
        return F.lit(True)
    return F.substring(hex_draw, 1, 8) < F.lit(f"{round(fraction * 2**32):08x}")
