"""Column expressions: calendar fields, name repair, truncating arithmetic."""

from regioncast.functions.arith import avg_per_unit_day, clamp_at_zero, idiv, share
from regioncast.functions.calendar import (
    ITALIAN_MONTHS,
    day_string,
    day_x,
    days_in_month,
    doy_to_date,
    first_day_label,
    month_label,
    month_number,
    month_start,
    next_month_start,
    parse_day,
)
from regioncast.functions.names import DEFAULT_NAME_RULES, normalise_names, repaired_name

__all__ = [
    "ITALIAN_MONTHS", "DEFAULT_NAME_RULES",
    "avg_per_unit_day", "clamp_at_zero", "idiv", "share",
    "day_string", "day_x", "days_in_month", "doy_to_date", "first_day_label",
    "month_label", "month_number", "month_start", "next_month_start", "parse_day",
    "normalise_names", "repaired_name",
]
