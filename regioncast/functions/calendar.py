"""Calendar column expressions (dates, months, labels).

Everything here is a plain ``Column`` built from Spark's own functions, so
it stays inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names as the reference prints them (Italian, capitalised),
# January first.
ITALIAN_MONTHS = [
    "Gennaio", "Febbraio", "Marzo", "Aprile", "Maggio", "Giugno",
    "Luglio", "Agosto", "Settembre", "Ottobre", "Novembre", "Dicembre",
]

DAY_FORMAT = "yyyy-MM-dd"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_day(c: str | Column, lenient: bool = False, mode: str | None = None) -> Column:
    """Parse a ``yyyy-MM-dd`` string to a date.

    ``strict`` (default) raises on malformed input (ANSI mode); ``lenient``
    (or ``lenient=True``) gives NULL instead; ``smart`` resolves a day past
    the end of its month to the month's last day (``2021-02-30`` ->
    ``2021-02-28``), as Java's default date resolver does, and gives NULL
    for text that is not three numbers with a valid month.
    """
    c = _col(c)
    mode = mode or ("lenient" if lenient else "strict")
    if mode == "strict":
        return F.to_date(c, DAY_FORMAT)
    if mode == "lenient":
        return F.try_to_date(c, DAY_FORMAT)
    if mode == "smart":
        parts = F.split(c, "-")
        y, m, d = (F.get(parts, F.lit(i)).try_cast("int") for i in range(3))
        first = F.when((F.size(parts) == 3) & m.between(1, 12) & d.between(1, 31),
                       F.make_date(y, m, F.lit(1)))
        return F.date_add(first, F.least(d, F.dayofmonth(F.last_day(first))) - 1)
    raise ValueError(f"unknown parse mode {mode!r}")


def day_string(d: str | Column) -> Column:
    """Date back to its ``yyyy-MM-dd`` text."""
    return F.date_format(_col(d), DAY_FORMAT)


def month_start(d: str | Column) -> Column:
    """First day of the month: the grouping key for a month (keeps the year)."""
    return F.trunc(_col(d), "MM")


def month_number(d: str | Column) -> Column:
    return F.month(_col(d))


def month_label(d: str | Column, lang: str = "it", year: bool = False) -> Column:
    """Month name of a date: Italian (reference output) or upper-case English; ``year`` adds the year."""
    d = _col(d)
    if lang == "it":
        name = F.element_at(F.array(*[F.lit(m) for m in ITALIAN_MONTHS]), F.month(d))
    elif lang == "en":
        name = F.upper(F.date_format(d, "MMMM"))
    else:
        raise ValueError(f"unknown month label language {lang!r}")
    return F.concat(name, F.lit(" "), F.year(d).cast("string")) if year else name


def first_day_label(d: str | Column, lang: str = "it", year: bool = False) -> Column:
    """``'1 ' + month name`` of a date's month."""
    return F.concat(F.lit("1 "), month_label(d, lang, year))


def spans_years(lo: str | None, hi: str | None) -> bool:
    """Whether a window of days can hold one month of two years, so that labels need the year.

    A window of at most twelve months (and the day before it, for an open bound) has each month once.
    """
    if lo is None or hi is None:
        return True
    (y0, m0, _), (y1, m1, _) = (map(int, x.split("-")) for x in (lo, hi))
    return 12 * (y1 - y0) + m1 - m0 > 12


def days_in_month(d: str | Column) -> Column:
    """Length of the date's month, in the date's own year."""
    return F.dayofmonth(F.last_day(_col(d)))


def next_month_start(d: str | Column) -> Column:
    return F.date_add(F.last_day(_col(d)), 1)


def day_x(d: str | Column, mode: str = "dayofyear", origin: str | None = None) -> Column:
    """Day number used as the regression abscissa.

    ``dayofyear`` restarts every January (December lies right of June, as in
    the reference); ``elapsed`` counts days from ``origin`` (default
    1970-01-01).  A least-squares forecast does not depend on the origin.
    """
    d = _col(d)
    if mode == "dayofyear":
        return F.dayofyear(d)
    if mode == "elapsed":
        start = F.to_date(F.lit(origin or "1970-01-01"), DAY_FORMAT)
        return F.datediff(d, start)
    raise ValueError(f"unknown day mode {mode!r}")


def doy_to_date(year: str | Column, doy: str | Column) -> Column:
    """Day of year back to a date, in the given year."""
    return F.date_add(F.make_date(_col(year), F.lit(1), F.lit(1)), _col(doy) - 1)


def epoch_millis(ts: str | Column) -> Column:
    """Milliseconds since 1970-01-01 of a wall-clock timestamp, truncated.

    Computed on TIMESTAMP_NTZ, so the result does not depend on the
    session time zone.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MILLISECOND", epoch, _col(ts).cast("timestamp_ntz"))
