"""The driver contract: entry, query registry and oracle SQL."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from regioncast.sources.tables import TABLES
from tests.conftest import SF_SMALL

NO_SQL = {"kmeans_sweep", "model_report", "cells_q3_model", "cells_q3_cluster"}
SLOW = NO_SQL


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["mese", "regione", "numero_medio_vaccini"]
    assert df.count() > 0


def test_every_query_has_sql_unless_iterative():
    own = {n for n in queries() if n != "pipeline" and not n.startswith("op")}
    assert set(oracle_sql()) & own == own - NO_SQL


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)   # doubles must agree bit for bit
    return "<null>" if v is None else str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(n for n in oracle_sql() if n != "pipeline" and not n.startswith("op")))
def test_query_matches_oracle_small(spark, duck, name):
    sdf = queries()[name](spark, SF_SMALL)
    got = _canon(sdf.columns, [tuple(r) for r in sdf.collect()])
    res = duck.execute(oracle_sql()[name])
    want = _canon([d[0] for d in res.description], res.fetchall())
    assert got == want


PLANNED = {
    "q1_avg_daily_per_centre", "centres_per_area", "totals_by_month_area", "totals_by_day_area_band",
    "totals_by_area", "filter_open", "filter_half_open", "filter_upper", "calendar_fields", "names_repaired",
    "qualified_strict", "qualified_carryover", "filled_days", "predict_band_month", "predict_area",
    "top5_next_month_strict", "top5_next_month_carryover", "top5_next_month_filled", "coverage_share",
    "cluster_cost", "kmeans_sweep", "bisecting_sweep", "model_report", "cells_q3_model", "cells_q3_cluster",
    "position_scan", "cells_q1", "cells_q2", "cells_q3_share", "cells_put", "cells_latest", "cells_history",
    "cells_deleted", "cells_scan", "csv_round_trip", "compacted",
}


def test_planned_queries_are_registered():
    assert PLANNED <= set(queries())
    assert set(oracle_sql()) <= set(queries())
