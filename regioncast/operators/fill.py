"""Gap filling (G3): every calendar day of each present month, missing days as 0."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regioncast.functions.calendar import month_start


def fill_missing_days(df: DataFrame, keys: Sequence[str], day: str = "day", value: str = "n",
                      month: str | None = None) -> DataFrame:
    """For each (keys, month) present in ``df``, one row per day of that month.

    ``df`` holds one row per (keys, day) (a per-day series).  Days already
    present keep their value; the others get 0.  Each (keys, month) group has
    at most 31 rows, so its days are gathered into a day -> value map of at
    most 31 entries, the month's calendar is generated with ``sequence`` and
    each day looks itself up.  The group-by reuses the partitioning of an
    earlier (keys[, month]) window, and no join or second pass over the
    input is needed.  A ``month`` column of ``df`` (``month_start(day)``) is
    used as the group key and kept.

    Output columns: ``keys``, ``month`` (if given), ``day``, ``value``, in the
    order of ``df``.
    """
    keys = list(keys)
    m = month or "_f_month"
    rows = df if month else df.withColumn(m, month_start(day))
    per_month = rows.groupBy(*keys, m).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(day), F.col(value)))).alias("_f_days"))
    calendar = per_month.select(*keys, m, "_f_days",
                                F.explode(F.sequence(F.col(m), F.last_day(m))).alias(day))
    zero = F.lit(0).cast(dict(df.dtypes)[value])
    out = calendar.withColumn(value, F.coalesce(F.element_at("_f_days", F.col(day)), zero))
    wanted = set(keys) | {day, value} | ({month} if month else set())
    return out.select(*[c for c in df.columns if c in wanted])
