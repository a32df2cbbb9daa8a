"""Physical-plan properties that the design relies on at scale."""

import re

from regioncast import catalog
from regioncast.plans import avg_daily_doses_per_centre
from regioncast.sources import read_centres, read_daily_totals
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_text_day_window_reaches_parquet(spark, tmp_out):
    spark.createDataFrame([("2021-01-05", "x", 10, "A")], "d string, f string, t int, a string") \
        .write.parquet(f"{tmp_out}/summary")
    spark.createDataFrame([("c", "A")], "id string, a string").write.parquet(f"{tmp_out}/centres")
    q = avg_daily_doses_per_centre(read_daily_totals(spark, f"{tmp_out}/summary"),
                                   read_centres(spark, f"{tmp_out}/centres"))
    plan = _plan(q)
    assert re.search(r"PushedFilters: \[Or\(IsNull\(d\),And\(GreaterThan\(d,2020-12-31\),LessThan\(d,2021-06-01\)\)\)",
                     plan), plan
    # Only the three used columns of the four are read.
    assert "ReadSchema: struct<d:string,t:int,a:string>" in plan


def test_query2_top_n_is_limited_before_its_shuffle(spark):
    plan = _plan(catalog.QUERIES["top5_next_month_strict"](spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "partial_sum" in plan
    # per-day sum, qualification window, top-n and the final order: the
    # regression group-by reuses the window's partitioning.
    assert plan.count("Exchange hashpartitioning") == 3, plan


def test_query2_carryover_windows_share_one_shuffle(spark):
    plan = _plan(catalog.QUERIES["top5_next_month_carryover"](spark, SF_SMALL))
    assert plan.count("Exchange hashpartitioning") == 3, plan


def test_query2_fill_adds_no_join(spark):
    plan = _plan(catalog.QUERIES["top5_next_month_filled"](spark, SF_SMALL))
    assert "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 3, plan


def test_cluster_cost_is_one_aggregate_pass(spark):
    plan = _plan(catalog.QUERIES["cluster_cost"](spark, SF_SMALL))
    assert "Join" not in plan
    assert plan.count("Exchange hashpartitioning") == 1, plan


def test_date_windows_reach_the_scans_of_the_registered_queries(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # else the plan's text is cut
    lineitem = ("totals_by_day_area_band", "filter_half_open", "qualified_carryover", "predict_band_month", "top5_next_month_strict")
    orders = ("q1_avg_daily_per_centre", "totals_by_month_area", "filter_open")
    for names, column in ((lineitem, "l_shipdate"), (orders, "o_orderdate")):
        for name in names:
            plan = _plan(catalog.QUERIES[name](spark, SF_SMALL))
            pushed = next(line for line in plan.splitlines() if "PushedFilters" in line and column in line)
            assert f"GreaterThanOrEqual({column}," in pushed and f"LessThan({column}," in pushed, (name, pushed)
    for name in ("totals_by_area", "coverage_share", "predict_area", "filter_upper"):
        plan = _plan(catalog.QUERIES[name](spark, SF_SMALL))
        assert "LessThan(o_orderdate," in plan, (name, plan)


def test_cell_queries_without_broadcasts_give_the_same(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    names = ("cells_put", "cells_get", "cells_history", "cells_deleted", "cells_deleted_rows")
    rows = lambda: [sorted(map(tuple, catalog.QUERIES[n](spark, SF_SMALL).collect())) for n in names]
    before, want = spark.conf.get(key), rows()
    spark.conf.set(key, "-1")
    try:
        assert rows() == want
    finally:
        spark.conf.set(key, before)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_a_put_of_events_is_more_than_a_union(spark):
    from regioncast.sources import tables as T

    put = catalog.QUERIES["cells_put"](spark, SF_SMALL)
    events = T.event_cells(spark, SF_SMALL)
    assert put.count() < events.count()
    assert put.count() == events.select("row_key", "family", "qualifier", "ts").distinct().count()
