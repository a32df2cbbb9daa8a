"""Top-n per group and result ordering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                    rank_col: str | None = "rank") -> DataFrame:
    """First ``n`` rows of each group by ``order`` (up to n when a group is smaller, B6).

    ``row_number() <= n`` is planned as a WindowGroupLimit: each map task
    keeps only its own top n per group before the shuffle, so a huge group
    ships at most n rows per task.  Give a total order (e.g. value, then
    area) so ties are repeatable (B7).
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n)
    if rank_col:
        return ranked.withColumnRenamed("_rank", rank_col)
    return ranked.drop("_rank")


def order_result(df: DataFrame, *cols: str | Column) -> DataFrame:
    """Final ordering of a (small) result; a range-partitioned global sort."""
    return df.orderBy(*cols)
