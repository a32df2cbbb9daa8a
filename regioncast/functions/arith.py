"""Arithmetic column expressions with the reference's truncation rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def idiv(num: str | Column, den: str | Column) -> Column:
    """SQL ``div``: integral division truncated toward zero.

    Works on BIGINT and on DECIMAL(38,0) operands; a zero divisor raises
    under ANSI mode, so callers guard it with ``when``.
    """
    return F.call_function("div", _col(num), _col(den))


def avg_per_unit_day(total: str | Column, days: str | Column, units: str | Column) -> Column:
    """``total div (days * units)`` as BIGINT (P12): truncation, not rounding."""
    return idiv(_col(total).cast("bigint"), (_col(days) * _col(units)).cast("bigint"))


def share(part: str | Column, whole: str | Column) -> Column:
    """Double division."""
    return _col(part).cast("double") / _col(whole).cast("double")


def clamp_at_zero(c: str | Column) -> Column:
    """Negative values become 0."""
    return F.greatest(_col(c), F.lit(0).cast("bigint"))
