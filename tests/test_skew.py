"""Query 2 and Query 1 on inputs where one area holds most of the rows.

The skewed inputs are compared with DuckDB running the same oracle SQL over
exactly the same rows, so nothing is dropped or double-counted when one key
dominates.
"""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from regioncast import oracle
from regioncast.plans.params import STAND_IN as B
from regioncast.plans.query1 import avg_daily_doses_per_centre
from regioncast.plans.query2 import top_areas_next_month
from regioncast.sources import tables as T
from tests.conftest import SF_SMALL


def _norm(v):
    if isinstance(v, float):
        return f"{round(v, 9):.9f}"
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def skewed_doses(spark):
    doses = T.doses_by_band(spark, SF_SMALL)
    hot = doses.groupBy("area").count().orderBy(F.desc("count"), "area").first()["area"]
    copies = [doses.where(F.col("area") == hot) for _ in range(6)]
    skewed = doses
    for c in copies:
        skewed = skewed.unionByName(c)
    total = skewed.count()
    hot_rows = skewed.where(F.col("area") == hot).count()
    assert hot_rows * 3 >= total
    return skewed


@pytest.mark.parametrize("mode,fill,name", [("strict", False, "p_strict"), ("carryover", False, "p_carry"),
                                            ("strict", True, "p_filled")])
def test_query2_under_skew_matches_sql(spark, skewed_doses, mode, fill, name):
    got = top_areas_next_month(skewed_doses, B["first_february"], B["first_june"], mode=mode, zero_fill=fill)
    con = duckdb.connect()
    con.register("doses_skewed", skewed_doses.toArrow())
    kept = {"p_strict": "kept_strict", "p_carry": "kept_carryover", "p_filled": "kept_filled"}[name]
    sql = (oracle._with("doses_by_band AS (SELECT * FROM doses_skewed)", oracle.Q2_CTES,
                        oracle._q2_preds(kept, name)) + oracle._top5_select(name))
    res = con.execute(sql)
    want = _canon([d[0] for d in res.description], res.fetchall())
    assert _canon(got.columns, [tuple(r) for r in got.collect()]) == want


def test_query1_under_skew_matches_sql(spark):
    daily = T.daily_totals(spark, SF_SMALL)
    hot = daily.groupBy("area").count().orderBy(F.desc("count"), "area").first()["area"]
    skewed = daily
    for _ in range(6):
        skewed = skewed.unionByName(daily.where(F.col("area") == hot))
    got = avg_daily_doses_per_centre(skewed, T.centres(spark, SF_SMALL), B["last_december"], B["first_june"])
    con = duckdb.connect()
    con.register("daily_skewed", skewed.toArrow())
    con.register("centres_t", T.centres(spark, SF_SMALL).toArrow())
    sql = oracle._with("daily_totals AS (SELECT * FROM daily_skewed)", "centres AS (SELECT * FROM centres_t)",
                       oracle.Q1_CTES) + "SELECT mese, regione, numero_medio_vaccini FROM q1"
    res = con.execute(sql)
    want = _canon([d[0] for d in res.description], res.fetchall())
    rows = [tuple(r) for r in got.collect()]
    assert not any(isinstance(v, float) and math.isnan(v) for r in rows for v in r)
    assert _canon(got.columns, rows) == want
