"""Row predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filled(df: DataFrame, columns: list[str]) -> Column:
    """True when none of the columns is null or NaN.

    Written as single-column tests, which unlike `dropna` reach the file scan.
    """
    kinds = dict(df.dtypes)
    tests = [F.col(c).isNotNull() for c in columns]
    tests += [~F.isnan(c) for c in columns if kinds[c] in ("float", "double")]
    return reduce(lambda a, b: a & b, tests)


def complete_rows(df: DataFrame, required: list[str]) -> DataFrame:
    return df.filter(filled(df, required))
