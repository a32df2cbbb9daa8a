"""Hand-made inputs for queries 1-3 (FIXTURES.md section 4)."""

import pytest
from pyspark.sql import functions as F

from regioncast.operators import predict_linear, require_non_null, top_n_per_group
from regioncast.plans import avg_daily_doses_per_centre, coverage_share, top_areas_next_month

DT = "day string, total int, area string"


def test_b12_truncating_average(spark):
    days = [(f"2021-01-{i:02d}", 0, "X") for i in range(1, 32)]
    days[0] = ("2021-01-01", 7, "X")
    centres = spark.createDataFrame([(1, "X")], "centre int, area string")
    res = avg_daily_doses_per_centre(spark.createDataFrame(days, DT), centres).collect()
    assert [(r.mese, r.regione, r.numero_medio_vaccini) for r in res] == [("Gennaio", "X", 0)]
    days[0] = ("2021-01-01", 99, "X")
    res = avg_daily_doses_per_centre(spark.createDataFrame(days, DT), centres).collect()
    assert res[0].numero_medio_vaccini == 3


def test_inner_join_and_b9_years(spark):
    totals = spark.createDataFrame([
        ("2021-01-05", 310, "X"), ("2022-01-05", 620, "X"), ("2021-01-06", 50, "NoCentre")], DT)
    centres = spark.createDataFrame([(1, "X"), (2, "X")], "centre int, area string")
    res = avg_daily_doses_per_centre(totals, centres, lo="2020-12-31", hi="2022-06-01").collect()
    assert [(r.mese, r.regione, r.numero_medio_vaccini) for r in res] == [
        ("Gennaio 2021", "X", 5), ("Gennaio 2022", "X", 10)]


def test_b14_null_fails_clearly(spark):
    totals = spark.createDataFrame([("2021-01-05", None, "X")], DT)
    centres = spark.createDataFrame([(1, "X")], "centre int, area string")
    with pytest.raises(Exception, match="NULL value in required column 'total'"):
        avg_daily_doses_per_centre(totals, centres).collect()
    with pytest.raises(ValueError, match="total"):
        require_non_null(totals, ["day", "total"], eager=True)
    nulls_day = spark.createDataFrame([(None, 3, "X")], DT)
    with pytest.raises(Exception, match="'day'"):
        avg_daily_doses_per_centre(nulls_day, centres).collect()


def test_clamp_negative_forecast(spark):
    df = spark.createDataFrame([("g", 1, 10), ("g", 2, 5)], "g string, x int, y int")
    exact = predict_linear(df, ["g"], F.col("x"), F.col("y"), F.lit(10)).first()["pred"]
    approx = predict_linear(df, ["g"], F.col("x"), F.col("y"), F.lit(10), exact=False).first()["pred"]
    assert exact == 0 and approx == 0
    up = predict_linear(df, ["g"], F.col("x"), F.col("y"), F.lit(0)).first()["pred"]
    assert up == 15


def test_b6_b7_top_n(spark):
    df = spark.createDataFrame([("m", "a", 1), ("m", "b", 3), ("m", "c", 2)], "g string, area string, v int")
    assert top_n_per_group(df, ["g"], [F.desc("v"), F.asc("area")], 5).count() == 3
    ties = spark.createDataFrame([("m", a, v) for a, v in
                                  [("Veneto", 5), ("Lazio", 6), ("Toscana", 5), ("Puglia", 6), ("Sicilia", 5),
                                   ("Umbria", 4)]], "g string, area string, v int")
    top = top_n_per_group(ties, ["g"], [F.desc("v"), F.asc("area")], 5).orderBy("rank").collect()
    assert [r.area for r in top] == ["Lazio", "Puglia", "Sicilia", "Toscana", "Veneto"]


def test_query2_shape(spark):
    rows = []
    for area, base in (("A", 10), ("B", 20), ("C", 5)):
        for day in range(1, 6):
            rows.append((f"2021-02-{day:02d}", "P", "20-29", base + day, area))
            rows.append((f"2021-02-{day:02d}", "M", "20-29", 1, area))
    doses = spark.createDataFrame(rows, "day string, brand string, band string, n int, area string")
    res = top_areas_next_month(doses).collect()
    assert [r.regione for r in res] == ["B", "A", "C"]
    assert {r.giorno for r in res} == {"1 Marzo"}
    # n = base + day + 1 on days of year 32..36, i.e. n = x + base - 30; 1 March is day 60
    assert [r.predizione_vaccini for r in res] == [20 + 30, 10 + 30, 5 + 30]


def test_query3_share_and_name_repair(spark):
    totals = spark.createDataFrame([
        ("2021-05-01", 10, "Valle d'Aosta / Vallée d'Aoste"), ("2021-05-02", 10, "Valle d'Aosta / Vallée d'Aoste"),
        ("2021-06-01", 999, "Valle d'Aosta / Vallée d'Aoste")], DT)
    pop = spark.createDataFrame([("Valle d'Aosta", 100)], "area string, people int")
    res = coverage_share(totals, pop).collect()
    assert len(res) == 1
    r = res[0]
    assert r.regione == "Valle d'Aosta / Vallée d'Aoste" and r.giorno == "1 Giugno"
    assert r.predizione_percentuale_vaccini == pytest.approx((20 + 10) / 100)


def test_smart_parse_mode_reads_day_past_month_end(spark):
    totals = spark.createDataFrame([("2021-02-30", 56, "X"), ("2021-02-01", 0, "X")], DT)
    centres = spark.createDataFrame([(1, "X")], "centre int, area string")
    with pytest.raises(Exception):
        avg_daily_doses_per_centre(totals, centres).collect()
    res = avg_daily_doses_per_centre(totals, centres, parse_mode="smart").collect()
    assert [(r.mese, r.numero_medio_vaccini) for r in res] == [("Febbraio", 2)]


def test_b14_nulls_in_query2_and_query3_inputs(spark):
    doses = spark.createDataFrame([("2021-02-01", "P", None, 3, "A")],
                                  "day string, brand string, band string, n int, area string")
    with pytest.raises(Exception, match="'band'"):
        top_areas_next_month(doses).collect()
    totals = spark.createDataFrame([("2021-05-01", 10, "A")], DT)
    pop = spark.createDataFrame([("A", None)], "area string, people int")
    with pytest.raises(Exception, match="'people'"):
        coverage_share(totals, pop).collect()


def test_day_window_on_date_columns(spark):
    from tests.conftest import d

    from regioncast.operators import between_days

    df = spark.createDataFrame([(d("2020-12-31"),), (d("2021-01-01"),), (d("2021-05-31"),), (d("2021-06-01"),)],
                               "day date")
    opened = between_days(df, "day", "2020-12-31", "2021-06-01", lo_open=True, hi_open=True)
    assert sorted(r.day.isoformat() for r in opened.collect()) == ["2021-01-01", "2021-05-31"]
    closed = between_days(df, "day", "2020-12-31", "2021-06-01", lo_open=False, hi_open=False)
    assert closed.count() == 4


FOUR_ROWS = [("2021-01-01", 10), ("2021-01-02", 20), ("2021-01-03", 30), ("2021-01-xx", 1000)]


def _four(spark, rows=FOUR_ROWS):
    daily = spark.createDataFrame([(d, n, "A") for d, n in rows], "day string, total int, area string")
    return daily, spark.createDataFrame([("A",)], "area string")


def test_lenient_leaves_unreadable_days_out(spark):
    from regioncast.operators.filters import unreadable_days
    from regioncast.plans.query1 import avg_daily_doses_per_centre
    from regioncast.plans.query3 import area_forecasts

    daily, centres = _four(spark)
    got = avg_daily_doses_per_centre(daily, centres, parse_mode="lenient").collect()
    assert [tuple(r) for r in got] == [("Gennaio", "A", 60 // 31)]
    assert [tuple(r) for r in area_forecasts(daily, parse_mode="lenient").collect()] == [("A", 60, 1520)]
    assert unreadable_days(daily).count() == 1


def test_smart_and_strict_fail_on_unreadable_days(spark):
    import pytest

    from regioncast.plans.query1 import avg_daily_doses_per_centre
    from regioncast.plans.query3 import area_forecasts

    daily, centres = _four(spark)
    for run in (lambda m: avg_daily_doses_per_centre(daily, centres, parse_mode=m), lambda m: area_forecasts(daily, parse_mode=m)):
        with pytest.raises(Exception, match="unreadable day"):
            run("smart").collect()
        with pytest.raises(Exception):
            run("strict").collect()
    clamped, _ = _four(spark, [("2021-02-30", 28), ("2021-02-01", 28)])
    assert [tuple(r) for r in avg_daily_doses_per_centre(clamped, centres, parse_mode="smart").collect()] == [("Febbraio", "A", 2)]


def test_exact_forecast_of_very_many_points(spark):
    """Sums of 5 * 10**9 points a group, given as sums: the products stay inside 38 digits."""
    from pyspark.sql import functions as F

    from regioncast.operators.forecast import exact_forecast

    per_day, days, y = 5 * 10**9 // 150, range(1, 151), 10**6
    n, sx, sxx = per_day * 150, per_day * sum(days), per_day * sum(d * d for d in days)
    sums = spark.createDataFrame([(n, sx, n * y, sxx, sx * y)], "_n bigint, _sx bigint, _sy bigint, _sxx bigint, _sxy bigint")
    assert sums.select(exact_forecast(F.lit(152)).alias("p")).first().p == y


def test_results_conform_without_nulls(spark):
    import pytest

    from regioncast.schemas import QUERY1, conform

    good = spark.createDataFrame([("Gennaio", "A", 3)], "mese string, regione string, numero_medio_vaccini bigint")
    assert [f.nullable for f in conform(good, QUERY1).schema.fields] == [False] * 3
    assert [tuple(r) for r in conform(good, QUERY1).collect()] == [("Gennaio", "A", 3)]
    bad = spark.createDataFrame([("Gennaio", None, 3)], "mese string, regione string, numero_medio_vaccini bigint")
    with pytest.raises(Exception, match="NULL in result column"):
        conform(bad, QUERY1).collect()
