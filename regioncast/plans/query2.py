"""Query 2 (Z2): per month and age band, the areas with the most doses
forecast for the first day of the next month.

Plan: filtered scan -> sum over brands per (day, area, band) -> month
qualification (window over each (area, band) series) -> optional gap fill ->
least-squares sums per (area, band, month) -> forecast -> top n per
(next month, band) -> label -> order.

Shuffles: one for the per-day sum (with map-side partial sums), one to lay
the per-day series out by (area, band, month) in strict mode or (area, band)
in carry-over mode for the windows (the gap fill and the regression group-by
reuse that partitioning: ``month`` is computed once and passed along), and
one small one for the top n, which each map task has already cut to n rows
per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regioncast.functions.calendar import day_x, first_day_label, month_start, next_month_start, spans_years
from regioncast.operators.fill import fill_missing_days
from regioncast.operators.filters import between_days, day_of, require_non_null
from regioncast.operators.forecast import predict_linear
from regioncast.operators.qualify import qualify_months
from regioncast.operators.ranking import order_result, top_n_per_group
from regioncast.plans.params import MIN_DAYS, REFERENCE, TOP_N


def daily_band_totals(doses: DataFrame, lo: str | None, hi: str | None, parse_mode: str = "strict") -> DataFrame:
    """(day DATE, area, band, n BIGINT): doses summed over brands (A3)."""
    rows = between_days(doses, "day", lo, hi, lo_open=False, hi_open=True, keep_nulls=True, parse_mode=parse_mode)
    rows = require_non_null(rows, ["day", "band", "n", "area"], "doses by band")
    return (rows.groupBy(day_of(rows, "day", parse_mode).alias("day"), F.col("area"), F.col("band"))
            .agg(F.sum(F.col("n").cast("bigint")).alias("n")))


def qualified_days(doses: DataFrame, lo: str | None = REFERENCE["first_february"],
                   hi: str | None = REFERENCE["first_june"], mode: str = "strict",
                   min_days: int = MIN_DAYS, zero_fill: bool = False, parse_mode: str = "strict") -> DataFrame:
    """Per-day rows (day, area, band, n, month) that enter the regression (G1/G2, optional G3)."""
    daily = daily_band_totals(doses, lo, hi, parse_mode).withColumn("month", month_start("day"))
    kept = qualify_months(daily, ["area", "band"], "day", "n", mode=mode, min_days=min_days, month="month")
    if zero_fill:
        kept = fill_missing_days(kept, ["area", "band"], "day", "n", month="month")
    return kept


def band_month_forecasts(kept: DataFrame, x_mode: str = "dayofyear") -> DataFrame:
    """(area, band, month, target, pred): forecast for the first day of the next month."""
    rows = kept if "month" in kept.columns else kept.withColumn("month", month_start("day"))
    preds = predict_linear(rows, ["area", "band", "month"],
                           x=day_x("day", x_mode), y=F.col("n"),
                           at=day_x(next_month_start("month"), x_mode))
    return preds.withColumn("target", next_month_start("month"))


def top_areas_next_month(doses: DataFrame, lo: str | None = REFERENCE["first_february"],
                         hi: str | None = REFERENCE["first_june"], mode: str = "strict",
                         min_days: int = MIN_DAYS, zero_fill: bool = False, n: int = TOP_N,
                         x_mode: str = "dayofyear", lang: str = "it", ordered: bool = True,
                         parse_mode: str = "strict") -> DataFrame:
    """giorno STRING, fascia_eta STRING, regione STRING, predizione_vaccini INT.

    ``mode`` is ``strict`` (documented rule, default) or ``carryover`` (the
    reference's loop, B1); ``zero_fill`` adds missing days as 0 before the
    fit (the reference computes but discards that, B3).  Ties in the top n
    go to the area that sorts first (B7).
    """
    kept = qualified_days(doses, lo, hi, mode, min_days, zero_fill, parse_mode)
    preds = band_month_forecasts(kept, x_mode)
    top = top_n_per_group(preds, ["target", "band"], [F.desc("pred"), F.asc("area")], n)
    res = top.select(
        first_day_label("target", lang, spans_years(lo, hi)).alias("giorno"),
        F.col("band").alias("fascia_eta"),
        F.col("area").alias("regione"),
        F.col("pred").cast("int").alias("predizione_vaccini"),
        "target", "rank",
    )
    if ordered:
        res = order_result(res, "target", "fascia_eta", "rank")
    return res.drop("target", "rank")
