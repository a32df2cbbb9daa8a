"""Least-squares line per group, evaluated at one point.

The fit needs only five sums per group (n, Sx, Sy, Sxx, Sxy), so it is a
plain ``groupBy().agg()``: partial sums before the shuffle, no list of points
collected anywhere, whatever the size of a group.

Exact mode (x and y integers) evaluates the truncated forecast with integer
arithmetic.  With x counted from the target x0 (sx, sxx, sxy of x - x0) it is
the line's value at 0::

    pred = (Sy*sxx - sx*sxy) div (n*sxx - sx^2)

so truncation never depends on the last bit of a double, and no product has
more than two sums.  Rows without x or y are no points of a fit.  An undefined fit
(one point, or all x equal: ``den = 0``) predicts 0 (B2); negative forecasts
become 0 (P14).  Float mode uses ``regr_slope``/``regr_intercept``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regioncast.functions.arith import clamp_at_zero, idiv

_DEC = "decimal(38,0)"


def regression_sums(df: DataFrame, keys: Sequence[str | Column], x: Column, y: Column,
                    extra: Sequence[Column] = ()) -> DataFrame:
    """Per-group n, sx, sy, sxx, sxy (BIGINT) plus any ``extra`` aggregates."""
    both = x.isNotNull() & y.isNotNull()
    xb, yb = F.when(both, x.cast("bigint")), F.when(both, y.cast("bigint"))
    return df.groupBy(*keys).agg(
        F.count(xb).alias("_n"),
        F.sum(xb).alias("_sx"),
        F.sum(yb).alias("_sy"),
        F.sum(xb * xb).alias("_sxx"),
        F.sum(xb * yb).alias("_sxy"),
        *extra,
    )


def exact_forecast(at: Column) -> Column:
    """Truncated, clamped forecast at ``at`` from the columns of ``regression_sums``."""
    n, sx, sy, sxx, sxy = (F.col(c).cast(_DEC) for c in ("_n", "_sx", "_sy", "_sxx", "_sxy"))
    x0 = at.cast(_DEC)
    sxx = (sxx - 2 * x0 * sx + n * x0 * x0).cast(_DEC)
    sxy = (sxy - x0 * sy).cast(_DEC)
    sx = (sx - n * x0).cast(_DEC)
    den = (n * sxx - sx * sx).cast(_DEC)
    safe_div = F.when(den == 0, F.lit(1).cast(_DEC)).otherwise(den)
    value = idiv((sy * sxx - sx * sxy).cast(_DEC), safe_div)
    return F.when(den == 0, F.lit(0).cast("bigint")).otherwise(clamp_at_zero(value.cast("bigint")))


def predict_linear(df: DataFrame, keys: Sequence[str], x: Column, y: Column, at: Column,
                   exact: bool = True, out: str = "pred", keep_sums: bool = False) -> DataFrame:
    """One row per group: ``keys`` and the forecast ``out`` (BIGINT) at ``at``.

    ``x`` and ``y`` are row-level expressions; ``at`` is evaluated on the
    grouped row, so it may use the group keys (e.g. the next month's start).
    """
    keys = list(keys)
    if exact:
        sums = regression_sums(df, keys, x, y)
        res = sums.withColumn(out, exact_forecast(at))
    else:
        xd, yd = x.cast("double"), y.cast("double")
        sums = df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_n"),
            F.regr_slope(yd, xd).alias("_slope"),
            F.regr_intercept(yd, xd).alias("_intercept"),
        )
        raw = F.col("_intercept") + F.col("_slope") * at.cast("double")
        res = sums.withColumn(
            out,
            F.when(raw.isNull() | F.isnan(raw), F.lit(0).cast("bigint"))
             .otherwise(F.greatest(raw, F.lit(0.0)).cast("bigint")))
    cols = keys + [out] + ([c for c in res.columns if c.startswith("_")] if keep_sums else [])
    return res.select(*cols)
