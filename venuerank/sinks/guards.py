"""Checks before a table is handed to a serving store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    sample = duplicate_keys(df, keys).limit(5).collect()
    if sample:
        raise ValueError(f"duplicate keys on {keys}: {[tuple(row)[:-1] for row in sample]}")
    return df
