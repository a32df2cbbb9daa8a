"""Grouped counts and sums (A1-A4).

Both are declarative aggregates, so Spark plans a partial aggregate before
the shuffle and a final one after it: a key holding a third of the rows
still leaves every map task with one row for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(keys: str | Column | Sequence[str | Column]) -> list:
    return [keys] if isinstance(keys, (str, Column)) else list(keys)


def count_by(df: DataFrame, keys, name: str = "count") -> DataFrame:
    """Rows per key (A1)."""
    return df.groupBy(*_keys(keys)).agg(F.count(F.lit(1)).alias(name))


def sum_by(df: DataFrame, keys, value: str, name: str | None = None) -> DataFrame:
    """Sum of an integer count per key, widened to BIGINT (A2-A4)."""
    return df.groupBy(*_keys(keys)).agg(F.sum(F.col(value).cast("bigint")).alias(name or value))
