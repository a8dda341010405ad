"""Figures of a write, observed while it runs: nothing is read a second time.

Spark 4.1 can't apply a logistic regression in a session that has observed anything ("Task not serializable"),
so tables to be observed belong to a session of their own, see `session.sibling`.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from venuerank.sinks.writers import write_parquet


def watched(df: DataFrame, **facts: Column) -> tuple[DataFrame, Observation]:
    """`df`, and what will hold the aggregates `facts` of its rows once an action has run over it."""
    seen = Observation()
    return df.observe(seen, *[fact.alias(name) for name, fact in facts.items()]), seen


def write_observed(df: DataFrame, path: str, partition_by: str | None = None, **facts: Column) -> dict[str, Any]:
    """Write a table and give its `rows`, its nulls by column (`nulls`), and further aggregates.

    An empty table has no rows and no nulls; its further aggregates are left out.
    """
    nulls = {f"null {i}": F.count_if(F.col(f"`{c}`").isNull()) for i, c in enumerate(df.columns)}
    counted, seen = watched(df, rows=F.count(F.lit(1)), **nulls, **facts)
    write_parquet(counted, path, partition_by)
    found = seen.get
    return {
        "rows": found.get("rows", 0), "nulls": {c: found.get(f"null {i}", 0) for i, c in enumerate(df.columns)},
        **{name: found[name] for name in facts if name in found},
    }
