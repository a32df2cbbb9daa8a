"""Month qualification of daily series.

A series is one ``keys`` combination (area, band); its rows are days with a
count.  A month of a series *qualifies* when at least ``min_days`` of its
days have a non-zero count.

``strict``     keep the rows of qualifying months (the documented rule).
``carryover``  the reference's loop buffers the first row of a month before
               it notices the month change, so that row shares the fate of
               the previous month *present in the series*: kept iff that
               month qualifies.  All other rows follow their own month.

Both modes are windows over the series; the series rows arrive already
aggregated per day, so a window partition holds at most one row per day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regioncast.functions.calendar import month_start

MODES = ("strict", "carryover")


def qualify_months(df: DataFrame, keys: Sequence[str], day: str = "day", value: str = "n",
                   mode: str = "strict", min_days: int = 2, month: str | None = None) -> DataFrame:
    """Rows of ``df`` (a DATE column ``day``) that survive the month rule.

    ``month`` names a column of ``df`` already holding ``month_start(day)``;
    passing it lets a later group-by on (keys, month) reuse the windows'
    partitioning instead of shuffling again.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    keys = list(keys)
    if month is None:
        month = "_q_month"
        rows = df.withColumn(month, month_start(day))
    else:
        rows = df
    if mode == "strict":
        per_month = Window.partitionBy(*keys, month)
        rows = rows.withColumn("_q_ok", F.count_if(F.col(value) != 0).over(per_month) >= min_days)
        kept = rows.where("_q_ok")
    else:
        # Both windows are partitioned by the series keys alone, so one
        # shuffle serves them: the month count is a RANGE frame over the rows
        # of the same month, and the look-back is ordered by (month, day), a
        # sort that also satisfies the month-ordered frame.
        per_month = (Window.partitionBy(*keys).orderBy(month)
                     .rangeBetween(Window.currentRow, Window.currentRow))
        series = Window.partitionBy(*keys).orderBy(month, day)
        rows = rows.withColumn("_q_ok", F.count_if(F.col(value) != 0).over(per_month) >= min_days)
        prev_month = F.lag(month).over(series)
        prev_ok = F.lag("_q_ok").over(series)
        rows = rows.withColumn("_q_first", prev_month.isNull() | (prev_month != F.col(month))) \
                   .withColumn("_q_prev_ok", prev_ok)
        keep = F.when(F.col("_q_first") & F.col("_q_prev_ok").isNotNull(), F.col("_q_prev_ok")) \
                .otherwise(F.col("_q_ok"))
        kept = rows.where(keep)
    return kept.select(*df.columns)
