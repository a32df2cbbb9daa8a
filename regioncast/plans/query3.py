"""Query 3: forecast vaccinated share per area on the target day (Z3), then
clusters of areas by that share for two models and several k (Z4).

Shares plan: filtered scan -> one group-by per area that yields the total
and the regression sums together (the reference makes two passes and a join)
-> forecast -> join with the population (names repaired) -> share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regioncast.functions.arith import share
from regioncast.functions.calendar import day_x, first_day_label
from regioncast.functions.names import DEFAULT_NAME_RULES, normalise_names
from regioncast.operators.clustering import Sweep, kmeans_sweep, sweep
from regioncast.operators.filters import between_days, day_of, require_non_null
from regioncast.operators.forecast import exact_forecast, regression_sums
from regioncast.operators.ranking import order_result
from regioncast.plans.params import KS, MAX_ITER, MODELS, REFERENCE, SPLIT_ITER


def area_forecasts(daily_totals: DataFrame, hi: str = REFERENCE["first_june"],
                   x_mode: str = "dayofyear", origin: str | None = None, parse_mode: str = "strict") -> DataFrame:
    """(area, total BIGINT, pred BIGINT): total before ``hi`` and the forecast for ``hi`` (A4, A10).

    Every row is one point of the fit (rows are not pre-summed by day).
    """
    rows = between_days(daily_totals, "day", None, hi, hi_open=True, keep_nulls=True, parse_mode=parse_mode)
    rows = require_non_null(rows, ["day", "total", "area"], "daily totals")
    sums = regression_sums(rows, ["area"], x=day_x(day_of(rows, "day", parse_mode), x_mode, origin),
                           y=F.col("total"))
    target = day_x(F.to_date(F.lit(hi)), x_mode, origin)
    return sums.select("area", F.col("_sy").alias("total"), exact_forecast(target).alias("pred"))


def coverage_share(daily_totals: DataFrame, population: DataFrame, hi: str = REFERENCE["first_june"],
                   x_mode: str = "dayofyear", origin: str | None = None, lang: str = "it",
                   rules=DEFAULT_NAME_RULES, ordered: bool = True, parse_mode: str = "strict") -> DataFrame:
    """regione STRING, giorno STRING, predizione_percentuale_vaccini DOUBLE.

    Share = (doses before ``hi`` + forecast for ``hi``) / population, joined
    on the repaired area name; areas missing on either side drop out.
    """
    per_area = area_forecasts(daily_totals, hi, x_mode, origin, parse_mode)
    pop = normalise_names(require_non_null(population.select("area", "people"), ["area", "people"],
                                           "population"), "area", rules)
    joined = per_area.join(pop, on="area", how="inner")
    res = joined.select(
        F.col("area").alias("regione"),
        first_day_label(F.to_date(F.lit(hi)), lang).alias("giorno"),
        share(F.col("total") + F.col("pred"), F.col("people")).alias("predizione_percentuale_vaccini"),
    )
    return order_result(res, "regione") if ordered else res


def cluster_areas(shares: DataFrame, ks: Sequence[int] = KS, models: Sequence[str] = MODELS,
                  seed: int = 1, max_iter: int = MAX_ITER, bisecting: str = "bisecting", split_iter: int = SPLIT_ITER,
                  checkpoint: bool = True, parallel_fits: int = 4) -> tuple[DataFrame, DataFrame]:
    """(clusters, model report) over the shares of ``coverage_share``."""
    return kmeans_sweep(shares, key="regione", value="predizione_percentuale_vaccini", ks=ks,
                        models=models, seed=seed, max_iter=max_iter, bisecting=bisecting, split_iter=split_iter,
                        checkpoint=checkpoint, parallel_fits=parallel_fits)


def share_sweep(shares: DataFrame, ks: Sequence[int] = KS, models: Sequence[str] = MODELS, seed: int = 1) -> Sweep:
    """The same fits with what they took and the bisecting tree's leaves."""
    return sweep(shares, "regione", ["predizione_percentuale_vaccini"], ks, models, seed, MAX_ITER, split_iter=SPLIT_ITER)
