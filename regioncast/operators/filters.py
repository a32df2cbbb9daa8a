"""Date-window filters and required-column checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regioncast.functions.calendar import parse_day


def _is_string(df: DataFrame, col: str) -> bool:
    return dict(df.dtypes)[col] == "string"


def day_of(df: DataFrame, col: str = "day", parse_mode: str = "strict") -> Column:
    """The day column as a DATE: a DATE column as it is, text parsed.

    In ``smart`` mode text that is no day at all fails the query (``strict``
    fails on any malformed day); in ``lenient`` mode it is NULL.
    """
    if not _is_string(df, col):
        return F.col(col)
    parsed = parse_day(F.col(col), mode=parse_mode)
    if parse_mode == "smart":
        bad = F.raise_error(F.concat(F.lit(f"unreadable day in column '{col}': "), F.col(col)))
        return F.when(F.col(col).isNotNull() & parsed.isNull(), bad.cast("date")).otherwise(parsed)
    return parsed


def unreadable_days(df: DataFrame, col: str = "day") -> DataFrame:
    """Rows whose day text is not NULL and can't be parsed: what ``lenient`` mode leaves out."""
    if not _is_string(df, col):
        return df.where(F.lit(False))
    return df.where(F.col(col).isNotNull() & parse_day(F.col(col), mode="lenient").isNull())


def day_window(df: DataFrame, col: str = "day", lo: str | None = None, hi: str | None = None,
               lo_open: bool = False, hi_open: bool = True, keep_nulls: bool = False,
               parse_mode: str = "strict") -> Column:
    """Predicate for ``lo (<|<=) day (<|<=) hi`` on a date or ``yyyy-MM-dd`` text column.

    On text columns the same bounds are also given on the raw strings (ISO
    dates sort like text), which Parquet can use to skip row groups; the
    parsed comparison keeps the check exact.  ``keep_nulls`` lets NULL days of a
    text column (a raw input) through so that a later ``require_non_null`` can report them;
    on a DATE column, which is often a cast that Parquet can't test for NULL, a NULL day is
    in no window and the bounds are pushed.  Text that
    ``lenient`` mode can't read is never inside a window, bounded or not.
    """
    c = F.col(col)
    text = _is_string(df, col)
    d = day_of(df, col, parse_mode)
    raw: list[Column] = []      # comparisons on the stored column itself
    parsed: list[Column] = []   # comparisons on the parsed date (text columns)
    if lo is not None:
        lo_d = F.to_date(F.lit(lo))
        (parsed if text else raw).append((d > lo_d) if lo_open else (d >= lo_d))
        if text:
            raw.append((c > F.lit(lo)) if lo_open else (c >= F.lit(lo)))
    if hi is not None:
        hi_d = F.to_date(F.lit(hi))
        (parsed if text else raw).append((d < hi_d) if hi_open else (d <= hi_d))
        if text:
            raw.append((c < F.lit(hi)) if hi_open else (c <= F.lit(hi)))
    if text and parse_mode == "lenient":
        parsed.append(d.isNotNull())
    if keep_nulls and text:
        # ``day IS NULL OR (raw bounds)`` stays a filter Parquet can evaluate
        # on row-group statistics; the parsed checks must not join that OR
        # (they cannot be pushed), so they let a NULL day through by themselves.
        raw = [c.isNull() | p for p in raw]
        parsed = [F.when(c.isNull(), F.lit(True)).otherwise(F.coalesce(p, F.lit(False))) for p in parsed]
    cond = F.lit(True)
    for k, p in enumerate(raw + parsed):
        cond = p if k == 0 else cond & p
    return cond


def between_days(df: DataFrame, col: str = "day", lo: str | None = None, hi: str | None = None,
                 lo_open: bool = False, hi_open: bool = True, keep_nulls: bool = False,
                 parse_mode: str = "strict") -> DataFrame:
    """Rows whose day lies in the window.

    F1 open interval: ``lo_open=True, hi_open=True``; F2 half-open:
    ``lo_open=False, hi_open=True``; F3 upper bound only: ``lo=None``.
    ``parse_mode`` is passed to ``parse_day`` for text columns.
    """
    return df.where(day_window(df, col, lo, hi, lo_open, hi_open, keep_nulls, parse_mode))


def require_non_null(df: DataFrame, cols: Sequence[str], what: str = "input", eager: bool = False) -> DataFrame:
    """Fail with a clear message on NULL in a required column.

    By default the check runs inside the plan (``raise_error`` on the first
    NULL met), so it costs no extra pass over the data.  ``eager=True`` counts
    NULLs first and raises before the query runs (one extra scan).
    """
    if eager:
        counts = df.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
        bad = [c for c in cols if counts[c]]
        if bad:
            raise ValueError(f"{what}: NULL values in required column(s) {', '.join(bad)}")
        return df
    return df.withColumns({
        c: F.when(F.col(c).isNull(),
                  F.raise_error(F.lit(f"{what}: NULL value in required column '{c}'")))
            .otherwise(F.col(c))
        for c in cols
    })
