"""DataFrame -> DataFrame operators."""

from regioncast.operators.aggregate import count_by, sum_by
from regioncast.operators.cells import (
    cell_history,
    delete_cells,
    latest_cells,
    put_cells,
    resolve_versions,
    scan_cells,
    to_cells,
)
from regioncast.operators.fill import fill_missing_days
from regioncast.operators.filters import between_days, day_window, require_non_null
from regioncast.operators.forecast import exact_forecast, predict_linear, regression_sums
from regioncast.operators.qualify import qualify_months
from regioncast.operators.ranking import order_result, top_n_per_group

__all__ = [
    "count_by", "sum_by",
    "cell_history", "delete_cells", "latest_cells", "put_cells", "resolve_versions", "scan_cells", "to_cells",
    "fill_missing_days", "between_days", "day_window", "require_non_null",
    "exact_forecast", "predict_linear", "regression_sums", "qualify_months",
    "order_result", "top_n_per_group",
]
