"""Bounded samples that fall the same way whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SLACK = 1.25  # share of rows beyond those asked for that is let through to the exact cut


def first_by_hash(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The `rows` rows of the smallest hashes of `key`, ties by the columns in order.

    A threshold on the hash, set from the number of rows, leaves little more than asked for
    before rows of different partitions meet, so what meets doesn't grow with the input.
    """
    total = df.count()
    if total > _SLACK * rows + 1000:
        limit = int((_SLACK * rows + 1000) / total * (1 << 32))
        df = df.filter(F.xxhash64(key).bitwiseAND(F.lit((1 << 32) - 1)) < limit)
    order = [F.xxhash64(key).bitwiseAND(F.lit((1 << 32) - 1)), *[F.col(c) for c in df.columns]]
    return df.orderBy(*order).limit(rows)
