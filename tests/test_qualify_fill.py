"""Month qualification (B1, B2), gap filling (B3), and the carry-over rule
against a plain loop that buffers each row before checking the month."""

import datetime as dt
import random

from pyspark.sql import functions as F

from regioncast.functions import next_month_start
from regioncast.operators import fill_missing_days, predict_linear, qualify_months
from tests.conftest import d

SCHEMA = "area string, band string, day date, n bigint"


def _series(spark, rows, area="A", band="b"):
    return spark.createDataFrame([(area, band, d(day), n) for day, n in rows], SCHEMA)


def _days(df):
    return sorted(r["day"].isoformat() for r in df.collect())


def test_b1_drop(spark):
    s = _series(spark, [("1997-02-01", 5), ("1997-03-01", 1), ("1997-03-02", 2), ("1997-03-03", 3)])
    strict = _days(qualify_months(s, ["area", "band"], mode="strict"))
    carry = _days(qualify_months(s, ["area", "band"], mode="carryover"))
    assert strict == ["1997-03-01", "1997-03-02", "1997-03-03"]
    assert carry == ["1997-03-02", "1997-03-03"]


def test_b1_b2_leak_predicts_zero(spark):
    s = _series(spark, [("1997-02-01", 5), ("1997-02-02", 6), ("1997-03-01", 4)])
    strict = qualify_months(s, ["area", "band"], mode="strict")
    carry = qualify_months(s, ["area", "band"], mode="carryover")
    assert "1997-03-01" not in _days(strict)
    assert _days(carry) == ["1997-02-01", "1997-02-02", "1997-03-01"]
    rows = carry.withColumn("month", F.trunc("day", "MM"))
    pred = predict_linear(rows, ["area", "band", "month"], F.dayofyear("day"), F.col("n"),
                          F.dayofyear(next_month_start("month")))
    march = [r for r in pred.collect() if r["month"] == d("1997-03-01")]
    assert len(march) == 1 and march[0]["pred"] == 0


def test_b1_gap_month_uses_previous_present_month(spark):
    s = _series(spark, [("1997-02-01", 5), ("1997-02-02", 6), ("1997-04-01", 4)])
    assert "1997-04-01" in _days(qualify_months(s, ["area", "band"], mode="carryover"))


def test_zero_days_do_not_qualify(spark):
    s = _series(spark, [("1997-02-01", 0), ("1997-02-02", 7), ("1997-02-03", 0)])
    assert _days(qualify_months(s, ["area", "band"], mode="strict")) == []


def test_b3_fill(spark):
    s = _series(spark, [("1997-02-01", 28), ("1997-02-28", 28)])
    filled = fill_missing_days(s, ["area", "band"], "day", "n")
    vals = [r["n"] for r in filled.collect()]
    assert len(vals) == 28 and vals.count(0) == 26
    rows = s.withColumn("month", F.trunc("day", "MM"))
    pred = predict_linear(rows, ["area", "band", "month"], F.dayofyear("day"), F.col("n"),
                          F.dayofyear(next_month_start("month"))).first()
    assert pred["pred"] == 28


def _loop_carryover(series, min_days=2):
    """The reference's month loop as described: append, then look at the month."""
    kept, buffer, count, prev = [], [], 0, None
    for day, n in series:
        month = (day.year, day.month)
        buffer.append(day)
        if prev is None:
            count += n != 0
        elif month == prev:
            count += n != 0
        else:
            if count >= min_days:
                kept.extend(buffer)
            buffer, count = [], int(n != 0)
        prev = month
    if count >= min_days:
        kept.extend(buffer)
    return kept


def test_carryover_matches_loop_on_random_series(spark):
    rng = random.Random(7)
    rows, expected = [], set()
    start = dt.date(1997, 1, 20)
    for g in range(300):
        days = sorted(rng.sample(range(0, 130), rng.randint(1, 25)))
        series = [(start + dt.timedelta(days=x), rng.choice([0, 0, 1, 2, 5])) for x in days]
        for day, n in series:
            rows.append((f"a{g}", "b", day, n))
        expected |= {(f"a{g}", day) for day in _loop_carryover(series)}
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r["area"], r["day"]) for r in qualify_months(df, ["area", "band"], mode="carryover").collect()}
    assert got == expected


def test_fill_matches_calendar_on_random_series(spark):
    import calendar

    rng = random.Random(3)
    rows, expected = [], set()
    for g in range(120):
        months = sorted(rng.sample(range(1, 13), rng.randint(1, 3)))
        present = {}
        for m in months:
            last = calendar.monthrange(1996, m)[1]
            for day in rng.sample(range(1, last + 1), rng.randint(1, 6)):
                present[dt.date(1996, m, day)] = rng.randint(0, 9)
        for day, n in present.items():
            rows.append((f"a{g}", "b", day, n, day.replace(day=1)))
        for m in months:
            for day in range(1, calendar.monthrange(1996, m)[1] + 1):
                date = dt.date(1996, m, day)
                expected.add((f"a{g}", date, present.get(date, 0), date.replace(day=1)))
    df = spark.createDataFrame(rows, SCHEMA + ", month date")
    filled = fill_missing_days(df, ["area", "band"], "day", "n", month="month")
    assert filled.columns == ["area", "band", "day", "n", "month"]
    got = {(r.area, r.day, r.n, r.month) for r in filled.collect()}
    assert got == expected
    assert filled.count() == len(expected)
