import pytest
from pyspark.sql import functions as F

from regioncast.functions import (
    day_string,
    day_x,
    days_in_month,
    doy_to_date,
    first_day_label,
    month_label,
    month_start,
    next_month_start,
    parse_day,
)
from regioncast.functions.calendar import epoch_millis


def _one(spark, expr, day):
    return spark.createDataFrame([(day,)], "day string").select(expr.alias("v")).first()["v"]


def test_parse_and_labels(spark):
    p = parse_day("day")
    assert _one(spark, day_string(month_start(p)), "1997-02-11") == "1997-02-01"
    assert _one(spark, month_label(p), "1997-02-11") == "Febbraio"
    assert _one(spark, month_label(p, "en"), "1997-02-11") == "FEBRUARY"
    assert _one(spark, first_day_label(next_month_start(p)), "1997-05-31") == "1 Giugno"
    assert _one(spark, day_string(next_month_start(p)), "1997-12-15") == "1998-01-01"


def test_strict_parse_fails_lenient_gives_null(spark):
    with pytest.raises(Exception):
        _one(spark, parse_day("day"), "2021-02-30x")
    assert _one(spark, parse_day("day", lenient=True), "not a day") is None


def test_smart_parse_clamps_day_like_java(spark):
    smart = day_string(parse_day("day", mode="smart"))
    assert _one(spark, smart, "2021-02-30") == "2021-02-28"
    assert _one(spark, smart, "2020-02-30") == "2020-02-29"
    assert _one(spark, smart, "2021-04-31") == "2021-04-30"
    assert _one(spark, smart, "2021-05-17") == "2021-05-17"
    assert _one(spark, smart, "2021-13-01") is None


def test_b8_month_length_uses_data_year(spark):
    p = parse_day("day")
    assert _one(spark, days_in_month(p), "2020-02-10") == 29
    assert _one(spark, days_in_month(p), "2021-02-10") == 28


def test_b5_day_numbers(spark):
    p = parse_day("day")
    assert _one(spark, day_x(p, "dayofyear"), "1996-12-27") == 362
    assert _one(spark, day_x(p, "elapsed", origin="1996-12-27"), "1996-12-27") == 0
    assert _one(spark, day_x(p, "elapsed", origin="1996-12-27"), "1997-01-01") == 5


def test_doy_round_trip(spark):
    p = parse_day("day")
    assert _one(spark, day_string(doy_to_date(F.year(p), F.dayofyear(p))), "2020-12-31") == "2020-12-31"


def test_epoch_millis_truncates_and_ignores_time_zone(spark):
    df = spark.createDataFrame([("1970-01-01 00:00:01.999999",)], "t string")
    assert df.select(epoch_millis(F.col("t").cast("timestamp_ntz")).alias("v")).first()["v"] == 1999
