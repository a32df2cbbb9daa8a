"""Composite queries built from the operators."""

from regioncast.plans.query1 import avg_daily_doses_per_centre, centres_per_area, month_area_totals
from regioncast.plans.query2 import band_month_forecasts, daily_band_totals, qualified_days, top_areas_next_month
from regioncast.plans.query3 import area_forecasts, cluster_areas, coverage_share

__all__ = [
    "avg_daily_doses_per_centre", "centres_per_area", "month_area_totals",
    "band_month_forecasts", "daily_band_totals", "qualified_days", "top_areas_next_month",
    "area_forecasts", "cluster_areas", "coverage_share",
]
