"""Query 1 (Z1): average daily doses per vaccination centre, per month and area.

Plan: filtered scan -> partial/final sum per (month start, area) -> join with
centres per area -> truncating division by (days of month x centres) ->
label -> order.  Both join sides are aggregates with one row per
(month, area) and per area; AQE turns the join into a broadcast once the
measured size of the centre side is under the broadcast threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regioncast.functions.arith import avg_per_unit_day
from regioncast.functions.calendar import days_in_month, month_label, month_start, spans_years
from regioncast.operators.aggregate import count_by
from regioncast.operators.filters import between_days, day_of, require_non_null
from regioncast.operators.ranking import order_result
from regioncast.plans.params import REFERENCE


def month_area_totals(daily_totals: DataFrame, lo: str | None, hi: str | None,
                      lo_open: bool = True, hi_open: bool = True, parse_mode: str = "strict") -> DataFrame:
    """(month DATE, area, total BIGINT) for the days in the window (A2)."""
    rows = between_days(daily_totals, "day", lo, hi, lo_open=lo_open, hi_open=hi_open, keep_nulls=True,
                        parse_mode=parse_mode)
    rows = require_non_null(rows, ["day", "total", "area"], "daily totals")
    return (rows.groupBy(month_start(day_of(rows, "day", parse_mode)).alias("month"), F.col("area"))
            .agg(F.sum(F.col("total").cast("bigint")).alias("total")))


def centres_per_area(centres: DataFrame) -> DataFrame:
    """(area, centres BIGINT) (A1)."""
    return count_by(require_non_null(centres.select("area"), ["area"], "centres"), "area", "centres")


def avg_daily_doses_per_centre(daily_totals: DataFrame, centres: DataFrame,
                               lo: str = REFERENCE["last_december"], hi: str = REFERENCE["first_june"],
                               lang: str = "it", ordered: bool = True, parse_mode: str = "strict") -> DataFrame:
    """mese STRING, regione STRING, numero_medio_vaccini BIGINT.

    Days strictly between ``lo`` and ``hi``; an area without centres drops
    out (inner join).  Month length comes from the data's own year (B8) and
    months of different years stay apart (B9).  ``parse_mode="smart"`` reads
    day text as the reference's parser does (``2021-02-30`` is 28 February).
    Over a window of more than a year labels carry the year, so they stay keys.
    """
    totals = month_area_totals(daily_totals, lo, hi, parse_mode=parse_mode)
    joined = totals.join(centres_per_area(centres), on="area", how="inner")
    res = joined.select(
        month_label("month", lang, spans_years(lo, hi)).alias("mese"),
        F.col("area").alias("regione"),
        avg_per_unit_day("total", days_in_month("month"), "centres").alias("numero_medio_vaccini"),
        F.col("month"),
    )
    if ordered:
        res = order_result(res, "month", "regione")
    return res.drop("month")
