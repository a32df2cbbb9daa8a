"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator
or composite query, run on the stand-in views of the driver's tables.

Every query reads whole tables; the only parameters are the fixed date
bounds (1997 standing in for 2021), the split of the events into two put batches
by the parity of their id, and for key lookups and deletes the list of keys (the suppliers').
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regioncast.functions.calendar import (
    day_string,
    day_x,
    days_in_month,
    doy_to_date,
    first_day_label,
    month_label,
    month_number,
    month_start,
    next_month_start,
    parse_day,
)
from regioncast.functions.names import normalise_names
from regioncast.operators.aggregate import count_by, sum_by
from regioncast.operators.cells import (
    cell_history,
    delete_cells,
    history_map,
    latest_cells,
    put_cells,
    resolve_versions,
    scan_cells,
    store_cells,
)
from regioncast.operators.clustering import cluster_cost, vectors
from regioncast.operators.filters import between_days, unreadable_days
from regioncast.operators.forecast import predict_linear
from regioncast.plans.exports import (
    CLUSTER,
    COST,
    PERFORMANCE,
    export_q1_cells,
    export_q2_cells,
    export_q3_cluster_cells,
    export_q3_model_cells,
    export_q3_share_cells,
)
from regioncast.plans.params import KS
from regioncast.plans.params import STAND_IN as B
from regioncast.plans.query1 import avg_daily_doses_per_centre, centres_per_area, month_area_totals
from regioncast.plans.query2 import band_month_forecasts, daily_band_totals, qualified_days, top_areas_next_month
from regioncast.plans.query3 import area_forecasts, cluster_areas, coverage_share, share_sweep
from regioncast.plans.run import run_all
from regioncast.session import shared_dir
from regioncast.sinks.files import compact, preview, write_csv, write_result
from regioncast.sources import tables as T
from regioncast.sources.files import REFERENCE_FILES, by_position, ingest_csv, read_inputs, read_result
from regioncast.streaming.ingest import ingest_csv_stream

# Version stamp of exported cells in the registered queries (a fixed batch
# number keeps the output comparable run to run).
EXPORT_TS = 1
# Column deleted for every user in ``cells_deleted`` and ``cells_deleted_all``, and scanned in ``cells_scan``.
EVENT_FAMILY, EVENT_COLUMN = "web", "click"
# Repair rules of ``names_repaired``: they meet the stand-in names, several at once in some.
NAME_RULES = [("_1", "Uno / One"), ("2", "Due / Two")]

DAILY_TOTALS_SCHEMA = "day STRING, total BIGINT, area STRING"


# ---- Query 1 and its parts -------------------------------------------------

def q1_avg_daily_per_centre(spark: SparkSession, sf: str) -> DataFrame:
    return avg_daily_doses_per_centre(T.daily_totals(spark, sf), T.centres(spark, sf),
                                      B["last_december"], B["first_june"])


def q_centres_per_area(spark: SparkSession, sf: str) -> DataFrame:
    return centres_per_area(T.centres(spark, sf))


def q_totals_by_month_area(spark: SparkSession, sf: str) -> DataFrame:
    t = month_area_totals(T.daily_totals(spark, sf), B["last_december"], B["first_june"])
    return t.select(day_string("month").alias("month"), "area", "total")


def q_totals_by_day_area_band(spark: SparkSession, sf: str) -> DataFrame:
    t = daily_band_totals(T.doses_by_band(spark, sf), B["first_february"], B["first_june"])
    return t.select(day_string("day").alias("day"), "area", "band", "n")


def q_totals_by_area(spark: SparkSession, sf: str) -> DataFrame:
    rows = between_days(T.daily_totals(spark, sf), "day", None, B["first_june"])
    return sum_by(rows, "area", "total")


def _text_day(df: DataFrame) -> DataFrame:
    return df.withColumn("day", day_string("day"))


def q_filter_open(spark: SparkSession, sf: str) -> DataFrame:
    return _text_day(between_days(T.daily_totals(spark, sf), "day", B["last_december"], B["first_june"],
                                  lo_open=True, hi_open=True))


def q_filter_half_open(spark: SparkSession, sf: str) -> DataFrame:
    return _text_day(between_days(T.doses_by_band(spark, sf), "day", B["first_february"], B["first_june"],
                                  lo_open=False, hi_open=True))


def q_filter_upper(spark: SparkSession, sf: str) -> DataFrame:
    return _text_day(between_days(T.daily_totals(spark, sf), "day", None, B["first_june"]))


def q_calendar_fields(spark: SparkSession, sf: str) -> DataFrame:
    days = T.daily_totals(spark, sf).select(F.col("day").alias("d")).distinct()
    return days.select(
        day_string("d").alias("day"),
        day_string(month_start("d")).alias("month_start"),
        month_number("d").alias("month_number"),
        days_in_month("d").alias("days_in_month"),
        day_x("d", "dayofyear").alias("day_of_year"),
        day_x("d", "elapsed").alias("days_since_epoch"),
        day_string(next_month_start("d")).alias("next_month_start"),
        month_label("d", "it").alias("mese"),
        month_label("d", "en").alias("month_en"),
        first_day_label(next_month_start("d"), "it").alias("next_first_day"),
        day_string(doy_to_date(F.year("d"), F.dayofyear("d"))).alias("doy_round_trip"),
    )


def q_names_repaired(spark: SparkSession, sf: str) -> DataFrame:
    return normalise_names(T.population(spark, sf), "area", NAME_RULES)


def _days_as_text(spark: SparkSession, sf: str) -> DataFrame:
    """Daily totals with days as text, as raw files have them; the 31st of a month is written unreadably."""
    text = day_string("day")
    return T.daily_totals(spark, sf).withColumn("day", F.when(F.dayofmonth("day") == 31, F.concat(F.left(text, F.lit(8)), F.lit("xx"))).otherwise(text))


def q1_lenient_days(spark: SparkSession, sf: str) -> DataFrame:
    """Query 1 on text days, some of them unreadable: ``lenient`` leaves their rows out."""
    return avg_daily_doses_per_centre(_days_as_text(spark, sf), T.centres(spark, sf),
                                      B["last_december"], B["first_june"], parse_mode="lenient")


def q_predict_area_lenient(spark: SparkSession, sf: str) -> DataFrame:
    """Totals and forecasts per area on text days, some of them unreadable."""
    return area_forecasts(_days_as_text(spark, sf), B["first_june"], parse_mode="lenient")


def q_unreadable_days(spark: SparkSession, sf: str) -> DataFrame:
    """How many rows ``lenient`` leaves out, per area."""
    return count_by(unreadable_days(_days_as_text(spark, sf)), "area", "rows_left_out")


def _positions(result: DataFrame) -> DataFrame:
    """The result with each row's place in the order in which it comes."""
    placed = result.withColumn("_at", F.monotonically_increasing_id())
    return placed.withColumn("place", F.row_number().over(Window.orderBy("_at"))).drop("_at")


def q1_in_order(spark: SparkSession, sf: str) -> DataFrame:
    return _positions(q1_avg_daily_per_centre(spark, sf))


def q_top5_in_order(spark: SparkSession, sf: str) -> DataFrame:
    return _positions(_top5("strict")(spark, sf))


def q_coverage_in_order(spark: SparkSession, sf: str) -> DataFrame:
    return _positions(q_coverage_share(spark, sf))


# ---- Query 2 and its parts -------------------------------------------------

def _qualified(spark, sf, mode, zero_fill=False):
    kept = qualified_days(T.doses_by_band(spark, sf), B["first_february"], B["first_june"],
                          mode=mode, zero_fill=zero_fill)
    return kept.select(day_string("day").alias("day"), "area", "band", "n")


def q_qualified_strict(spark: SparkSession, sf: str) -> DataFrame:
    return _qualified(spark, sf, "strict")


def q_qualified_carryover(spark: SparkSession, sf: str) -> DataFrame:
    return _qualified(spark, sf, "carryover")


def q_filled_days(spark: SparkSession, sf: str) -> DataFrame:
    return _qualified(spark, sf, "strict", zero_fill=True)


def q_predict_band_month(spark: SparkSession, sf: str) -> DataFrame:
    kept = qualified_days(T.doses_by_band(spark, sf), B["first_february"], B["first_june"], mode="strict")
    p = band_month_forecasts(kept)
    return p.select("area", "band", day_string("month").alias("month"),
                    day_string("target").alias("target"), "pred")


def q_predict_area(spark: SparkSession, sf: str) -> DataFrame:
    return area_forecasts(T.daily_totals(spark, sf), B["first_june"])


def q_predict_area_float(spark: SparkSession, sf: str) -> DataFrame:
    """Float least squares (regr_slope / regr_intercept) per area, before the cut-off day."""
    rows = between_days(T.daily_totals(spark, sf), "day", None, B["first_june"])
    fit = predict_linear(rows, ["area"], x=day_x("day"), y=F.col("total"),
                         at=day_x(F.to_date(F.lit(B["first_june"]))), exact=False, keep_sums=True)
    return fit.select("area", F.col("_n").alias("n_points"), F.round("_slope", 6).alias("slope"),
                      F.round("_intercept", 6).alias("intercept"))


def _top5(mode, zero_fill=False):
    def run(spark, sf):
        return top_areas_next_month(T.doses_by_band(spark, sf), B["first_february"], B["first_june"],
                                    mode=mode, zero_fill=zero_fill)
    return run


# ---- Query 3 ---------------------------------------------------------------

def q_coverage_share(spark: SparkSession, sf: str) -> DataFrame:
    return coverage_share(T.daily_totals(spark, sf), T.population(spark, sf), B["first_june"])


def q_coverage_share_elapsed(spark: SparkSession, sf: str) -> DataFrame:
    """Query 3 shares with days counted from an origin instead of day of year (B5 option)."""
    return coverage_share(T.daily_totals(spark, sf), T.population(spark, sf), B["first_june"], x_mode="elapsed")


def q_cluster_cost(spark: SparkSession, sf: str) -> DataFrame:
    costs = cluster_cost(T.table(spark, sf, "embeddings"), "embedding", "label")
    return costs.select("label", "n_points", F.round("cost", 6).alias("cost"))


def _sweep(spark, sf, models):
    shares = coverage_share(T.daily_totals(spark, sf), T.population(spark, sf), B["first_june"],
                            ordered=False)
    return cluster_areas(shares, models=models)


def q_kmeans_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return _sweep(spark, sf, ("K-MEANS",))[0]


def q_bisecting_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return _sweep(spark, sf, ("K-MEANS-BISECTING",))[0]


def q_model_report(spark: SparkSession, sf: str) -> DataFrame:
    return _sweep(spark, sf, ("K-MEANS", "K-MEANS-BISECTING"))[1]


def q_sweep_structure(spark: SparkSession, sf: str) -> DataFrame:
    """What must hold of every (model, k) of the sweep: points, clusters, labels that are ordered intervals, and a reported
    cost that equals the cost of the labels."""
    clusters, report = _sweep(spark, sf, ("K-MEANS", "K-MEANS-BISECTING"))
    run = ["modello", "k"]
    spans = clusters.groupBy(*run, "cluster").agg(F.count("*").alias("n"), F.min("percentuale_vaccinati").alias("low"),
                                                  F.max("percentuale_vaccinati").alias("high"))
    before = F.lag("high").over(Window.partitionBy(*run).orderBy("cluster"))
    shape = spans.withColumn("apart", F.coalesce(before < F.col("low"), F.lit(True))).groupBy(*run).agg(
        F.sum("n").alias("points"), F.count("*").alias("clusters"), F.bool_and("apart").alias("ordered_intervals"))
    points = vectors(clusters.withColumn("label", F.struct(*run, "cluster")), ["percentuale_vaccinati"])
    cost = cluster_cost(points, "features", "label").groupBy("label.modello", "label.k").agg(F.sum("cost").alias("cost"))
    same = F.abs(F.col("cost") - F.col("cost_WSSSE")) <= 1e-9 * F.col("cost_WSSSE")
    return (shape.join(cost, run).join(report, run)
            .select(*run, "points", "clusters", "ordered_intervals", same.alias("cost_of_labels")))


def _whole_sweep(spark, sf):
    return share_sweep(coverage_share(T.daily_totals(spark, sf), T.population(spark, sf), B["first_june"], ordered=False))


def q_sweep_optimality(spark: SparkSession, sf: str) -> DataFrame:
    """Whether every fit has converged, and its cost against the least cost that any k clusters of the shares have.

    A fit is a fixed point if every point is at least as near to the mean of its own cluster as to that of any other; in a bisecting
    fit this holds at every split, between the two sides.  The least cost is a dynamic programme over the sorted shares of the areas.
    """
    got, run = _whole_sweep(spark, sf), ["modello", "k"]
    x = F.col("predizione_percentuale_vaccini")
    # (choice, side): a k-means fit is one choice among its clusters, a bisecting fit one choice at each node above the leaf
    choices = F.expr("""if(node = 0, array(named_struct('choice', 0L, 'side', bigint(cluster))),
        transform(if(node > 1, sequence(1, int(floor(log2(node)))), array()),
                  d -> named_struct('choice', shiftright(node, d), 'side', shiftright(node, d - 1))))""")
    sides = got.clusters.select(*run, x.alias("x"), F.explode(choices).alias("c")).select(*run, "x", "c.choice", "c.side")
    means = sides.groupBy(*run, "choice", "side").agg(F.avg("x").alias("mean"))
    rivals = means.groupBy(*run, "choice").agg(F.collect_list("mean").alias("rivals"))  # k at most
    own = sides.join(means, [*run, "choice", "side"]).join(rivals, [*run, "choice"])
    near = F.abs(F.col("x") - F.col("mean")) <= F.array_min(F.transform("rivals", lambda m: F.abs(F.col("x") - m))) + 1e-12
    fixed = own.groupBy(*run).agg(F.bool_and(near).alias("fixed_point"))
    # one row: the shares of all areas about their mean, in order
    xs = got.clusters.where((F.col("modello") == "K-MEANS") & (F.col("k") == KS[0])).agg(F.avg(x).alias("m"), F.sort_array(F.collect_list(x)).alias("v"))
    xs = xs.select(F.transform("v", lambda v: v - F.col("m")).alias("x"), F.size("v").alias("n"))
    places = F.expr("sequence(0, n)")
    xs = xs.select("n", *(F.transform(places, lambda j: F.aggregate(F.slice("x", F.lit(1), j), F.lit(0.0), add)).alias(name)
                          for name, add in (("s", lambda acc, v: acc + v), ("q", lambda acc, v: acc + v * v))))
    part = "q[j] - q[i] - (s[j] - s[i]) * (s[j] - s[i]) / (j - i)"
    best = xs.withColumn("d1", F.expr(f"transform(sequence(0, n), j -> if(j = 0, 0D, {part.replace('[i]', '[0]').replace('- i)', '- 0)')}))"))
    for k in range(2, max(KS) + 1):
        best = best.withColumn(f"d{k}", F.expr(f"transform(sequence(0, n), j -> if(j = 0, 0D, array_min(transform(sequence(0, j - 1), i -> d{k - 1}[i] + {part}))))"))
    best = best.select(F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.expr(f"d{k}[n]").alias("least")) for k in KS))).alias("b")).select("b.k", "b.least")
    return fixed.join(got.report, run).join(best, "k").select(
        *run, "fixed_point", F.round("least", 9).alias("least_cost"), (F.col("cost_WSSSE") >= F.col("least") - 1e-12).alias("cost_not_below"))


def q_sweep_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """What each fit of the sweep took: passes, jobs and tasks counted by job group, and a wall time."""
    got = _whole_sweep(spark, sf).accounts
    return got.select("modello", "k", (F.col("steps") > 0).alias("stepped"), (F.col("jobs") >= F.col("steps")).alias("jobs_counted"),
                      (F.col("tasks") >= F.col("jobs")).alias("tasks_counted"), (F.col("wall_ms") > 0).alias("timed"))


# ---- Cells -----------------------------------------------------------------

def q_cells_q1(spark: SparkSession, sf: str) -> DataFrame:
    return export_q1_cells(q1_avg_daily_per_centre(spark, sf), EXPORT_TS)


def _reference_files(spark: SparkSession, sf: str, folder: str) -> dict[str, DataFrame]:
    """The four inputs written in the reference's column layout and read back by position."""
    day, filler = day_string("day").alias("giorno"), F.lit("-")
    daily, doses = T.daily_totals(spark, sf), T.doses_by_band(spark, sf)
    tables = {
        "daily_totals": daily.select(day, filler.alias("c1"), F.col("total").alias("totale"), filler.alias("c3"), F.col("area").alias("nome")),
        "centres": T.centres(spark, sf).select("centre", filler.alias("c1"), F.col("area").alias("nome")),
        "doses_by_band": doses.select(day, F.col("brand").alias("fornitore"), filler.alias("c2"), F.col("band").alias("fascia"),
                                      F.lit(0).alias("c4"), F.col("n").alias("donne"), F.col("area").alias("nome")),
        "population": T.population(spark, sf).select("area", "people", filler.alias("c2")),
    }
    for role, df in tables.items():
        write_result(df, folder, REFERENCE_FILES[role])
    return read_inputs(spark, folder)


def _full_run(spark: SparkSession, sf: str, *queries: str) -> tuple[str, dict[str, str]]:
    folder = shared_dir(spark, "full-run")
    inputs = _reference_files(spark, sf, f"{folder}/input")
    return f"{folder}/out", run_all(spark, inputs, f"{folder}/out", bounds=B, ts=EXPORT_TS, queries=queries)


def q_full_run_cells_q1(spark: SparkSession, sf: str) -> DataFrame:
    """The full run (Z5) of query 1 from files read by position: result written, read back and exported as cells."""
    _, paths = _full_run(spark, sf, "q1")
    return spark.read.parquet(paths["cells_q1"])


def q_full_run_cells_q2(spark: SparkSession, sf: str) -> DataFrame:
    """The same of query 2."""
    _, paths = _full_run(spark, sf, "q2")
    return spark.read.parquet(paths["cells_q2"])


def q_full_run_shares(spark: SparkSession, sf: str) -> DataFrame:
    """The full run of all three queries; the saved shares of query 3."""
    out, _ = _full_run(spark, sf, "q1", "q2", "q3")
    return read_result(spark, "query3_results", out)


def q_full_run_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """The full run of query 3; areas and clusters in the saved cluster table, per model and k."""
    out, _ = _full_run(spark, sf, "q3")
    saved = read_result(spark, "query3_cluster", out)
    return saved.groupBy("modello", "k").agg(F.countDistinct("regione").alias("areas"), F.countDistinct("cluster").alias("clusters"))


def q_cells_q2(spark: SparkSession, sf: str) -> DataFrame:
    return export_q2_cells(_top5("strict")(spark, sf), EXPORT_TS)


def q_cells_q3_share(spark: SparkSession, sf: str) -> DataFrame:
    return export_q3_share_cells(q_coverage_share(spark, sf), EXPORT_TS)


def q_cells_q3_model(spark: SparkSession, sf: str) -> DataFrame:
    return export_q3_model_cells(q_model_report(spark, sf), EXPORT_TS)


def q_cells_q3_cluster(spark: SparkSession, sf: str) -> DataFrame:
    clusters, _ = _sweep(spark, sf, ("K-MEANS", "K-MEANS-BISECTING"))
    return export_q3_cluster_cells(clusters, EXPORT_TS)


def q_cells_q3_model_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The model export without what differs from run to run or is not for SQL to say: times and costs."""
    return q_cells_q3_model(spark, sf).where(~F.col("qualifier").isin(PERFORMANCE, COST))


def q_cells_q3_cluster_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The cluster export without the labels."""
    return q_cells_q3_cluster(spark, sf).where(F.col("qualifier") != CLUSTER)


def _event_table(spark: SparkSession, sf: str) -> DataFrame:
    """The events of even id as a table, those of odd id put into it."""
    return put_cells(resolve_versions(T.event_cells(spark, sf, 0), "seq"), T.event_cells(spark, sf, 1), "seq")


def _supplier_keys(spark: SparkSession, sf: str, family: str | None = None) -> DataFrame:
    keys = T.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("row_key"))
    return keys.withColumn("family", F.lit(family)) if family else keys


def q_cells_put(spark: SparkSession, sf: str) -> DataFrame:
    return _event_table(spark, sf)


def q_cells_latest(spark: SparkSession, sf: str) -> DataFrame:
    return latest_cells(_event_table(spark, sf))


def q_cells_get(spark: SparkSession, sf: str) -> DataFrame:
    """Newest values of the rows of a key list."""
    return latest_cells(_event_table(spark, sf), keys=_supplier_keys(spark, sf))


def q_cells_history(spark: SparkSession, sf: str) -> DataFrame:
    """All versions of one family of the rows of a key list."""
    return cell_history(_event_table(spark, sf), keys=_supplier_keys(spark, sf, EVENT_FAMILY))


def _event_columns(spark: SparkSession, sf: str) -> DataFrame:
    cells = T.event_cells(spark, sf)
    return cells.where(F.col("qualifier") == EVENT_COLUMN).select("row_key", "family", "qualifier").distinct()


def q_cells_deleted(spark: SparkSession, sf: str) -> DataFrame:
    """A column of every row deleted: its newest version goes."""
    return delete_cells(_event_table(spark, sf), _event_columns(spark, sf), versions="latest")


def q_cells_deleted_all(spark: SparkSession, sf: str) -> DataFrame:
    """A column of every row deleted with all versions."""
    return delete_cells(_event_table(spark, sf), _event_columns(spark, sf), versions="all")


def q_cells_deleted_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of a key list deleted."""
    return delete_cells(_event_table(spark, sf), _supplier_keys(spark, sf))


def q_cells_deleted_family(spark: SparkSession, sf: str) -> DataFrame:
    """One family of the rows of a key list deleted."""
    return delete_cells(_event_table(spark, sf), _supplier_keys(spark, sf, EVENT_FAMILY))


def q_cells_scan(spark: SparkSession, sf: str) -> DataFrame:
    return scan_cells(_event_table(spark, sf), family=EVENT_FAMILY, qualifier=EVENT_COLUMN)


def q_cells_scan_family(spark: SparkSession, sf: str) -> DataFrame:
    return scan_cells(_event_table(spark, sf), family=EVENT_FAMILY)


# ---- Sources and sinks -------------------------------------------------------

def q_position_scan(spark: SparkSession, sf: str) -> DataFrame:
    return by_position(T.table(spark, sf, "customer"), [0, 2, -1])


def q_csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "csv-round-trip")
    path = write_csv(T.daily_totals(spark, sf), folder, "daily_totals")
    return ingest_csv(spark, path, DAILY_TOTALS_SCHEMA, dst=f"{folder}/parquet")


def q_stream_ingested(spark: SparkSession, sf: str) -> DataFrame:
    """Daily totals written as CSV files, then taken in by the streaming ingest (one availableNow run)."""
    folder = shared_dir(spark, "stream-ingest")
    src = write_csv(T.daily_totals(spark, sf), folder, "incoming")
    query = ingest_csv_stream(spark, src, DAILY_TOTALS_SCHEMA, f"{folder}/parquet", f"{folder}/checkpoint")
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/parquet")


def q_compacted(spark: SparkSession, sf: str) -> DataFrame:
    folder = shared_dir(spark, "compaction")
    daily = _text_day(T.daily_totals(spark, sf))
    staging = f"{folder}/staging"
    # Two appends, as results arrive in the reference, then one compaction.
    write_result(daily.where(F.col("day") < "1998-01-01"), folder, "staging", mode="append")
    write_result(daily.where(F.col("day") >= "1998-01-01"), folder, "staging", mode="append")
    return compact(spark, staging, f"{folder}/compacted")


def q_cells_history_map(spark: SparkSession, sf: str) -> DataFrame:
    """The same versions as one map per cell, shown as JSON."""
    maps = history_map(_event_table(spark, sf), keys=_supplier_keys(spark, sf, EVENT_FAMILY))
    return maps.select("row_key", "family", "qualifier", F.size("history").cast("long").alias("versions"), F.to_json("history").alias("history"))


def _stored(cells: DataFrame) -> DataFrame:
    """The cells as a table in buckets, written to the shared folder."""
    name = f"cells_{uuid.uuid4().hex[:12]}"
    return store_cells(cells, name, shared_dir(cells.sparkSession, name), buckets=8)


def q_cells_stored_put(spark: SparkSession, sf: str) -> DataFrame:
    """A put into a stored table: the events of even id are stored, those of odd id put into them."""
    return put_cells(_stored(resolve_versions(T.event_cells(spark, sf, 0), "seq")), T.event_cells(spark, sf, 1), "seq")


def q_cells_stored_get(spark: SparkSession, sf: str) -> DataFrame:
    """Newest values of the rows of a key list, from the stored table after the put."""
    return latest_cells(_stored(_event_table(spark, sf)), keys=_supplier_keys(spark, sf))


def q_cells_stored_deleted(spark: SparkSession, sf: str) -> DataFrame:
    """The newest version of a column of every row deleted, in the stored table after the put."""
    return delete_cells(_stored(_event_table(spark, sf)), _event_columns(spark, sf), versions="latest")


def _damaged_csv(spark: SparkSession, sf: str) -> str:
    """Daily totals as CSV files in which records of days 31 have no number for a total and those of days 30 a field too many."""
    day = F.dayofmonth("day")
    total = F.when(day == 31, F.lit("n/a")).otherwise(F.col("total").cast("string"))
    extra = F.when(day == 30, F.lit(",more")).otherwise(F.lit(""))
    lines = T.daily_totals(spark, sf).select(F.concat(day_string("day"), F.lit(","), total, F.lit(","), "area", extra).alias("day,total,area"))
    path = shared_dir(spark, "damaged")
    lines.write.option("header", True).option("sep", "|").csv(path)
    return path


def _kept_and_rejected(good: DataFrame, bad: DataFrame) -> DataFrame:
    kept = good.groupBy("area").agg(F.count("*").alias("kept"), F.sum("total").alias("total"))
    lost = bad.groupBy(F.split("record", ",")[2].alias("area")).agg(F.count("*").alias("rejected"))
    return kept.join(lost, "area", "full").select("area", F.coalesce("kept", F.lit(0)).alias("kept"), "total",
                                                  F.coalesce("rejected", F.lit(0)).alias("rejected"))


def q_csv_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Kept and rejected records per area of an ingest that goes on past malformed ones."""
    out = shared_dir(spark, "ingest")
    good = ingest_csv(spark, _damaged_csv(spark, sf), "day DATE, total BIGINT, area STRING", f"{out}/good", rejects=f"{out}/bad")
    return _kept_and_rejected(good, spark.read.parquet(f"{out}/bad"))


def q_stream_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """The same by the ingest stream."""
    out = shared_dir(spark, "stream")
    query = ingest_csv_stream(spark, _damaged_csv(spark, sf), "day DATE, total BIGINT, area STRING", f"{out}/good", f"{out}/done",
                              max_files_per_trigger=2, rejects=f"{out}/bad")
    query.awaitTermination()
    return _kept_and_rejected(spark.read.parquet(f"{out}/good"), spark.read.parquet(f"{out}/bad"))


def q_smart_days(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per day and area when every 28th is written as a 31st: a day past its month's end is the month's last day."""
    text = F.concat(F.date_format("day", "yyyy-MM-"), F.when(F.dayofmonth("day") == 28, "31").otherwise(F.date_format("day", "dd")))
    rows = T.daily_totals(spark, sf).select(parse_day(text, mode="smart").alias("day"), "area")
    return rows.groupBy("day", "area").agg(F.count("*").alias("n"))


def q_previewed(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows of query 1's result, as the debug preview shows them."""
    return preview(q1_avg_daily_per_centre(spark, sf).orderBy(F.desc("numero_medio_vaccini"), "mese", "regione"), 20)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q1_avg_daily_per_centre": q1_avg_daily_per_centre,
    "q1_in_order": q1_in_order,
    "q1_lenient_days": q1_lenient_days,
    "predict_area_lenient": q_predict_area_lenient,
    "unreadable_days": q_unreadable_days,
    "top5_in_order": q_top5_in_order,
    "coverage_in_order": q_coverage_in_order,
    "sweep_structure": q_sweep_structure,
    "sweep_optimality": q_sweep_optimality,
    "sweep_accounts": q_sweep_accounts,
    "full_run_cells_q2": q_full_run_cells_q2,
    "full_run_shares": q_full_run_shares,
    "full_run_clusters": q_full_run_clusters,
    "cells_q3_model_keys": q_cells_q3_model_keys,
    "cells_q3_cluster_keys": q_cells_q3_cluster_keys,
    "cells_get": q_cells_get,
    "cells_deleted_all": q_cells_deleted_all,
    "cells_deleted_rows": q_cells_deleted_rows,
    "cells_deleted_family": q_cells_deleted_family,
    "cells_scan_family": q_cells_scan_family,
    "centres_per_area": q_centres_per_area,
    "totals_by_month_area": q_totals_by_month_area,
    "totals_by_day_area_band": q_totals_by_day_area_band,
    "totals_by_area": q_totals_by_area,
    "filter_open": q_filter_open,
    "filter_half_open": q_filter_half_open,
    "filter_upper": q_filter_upper,
    "calendar_fields": q_calendar_fields,
    "names_repaired": q_names_repaired,
    "qualified_strict": q_qualified_strict,
    "qualified_carryover": q_qualified_carryover,
    "filled_days": q_filled_days,
    "predict_band_month": q_predict_band_month,
    "predict_area": q_predict_area,
    "top5_next_month_strict": _top5("strict"),
    "top5_next_month_carryover": _top5("carryover"),
    "top5_next_month_filled": _top5("strict", zero_fill=True),
    "top5_next_month_carryover_filled": _top5("carryover", zero_fill=True),
    "coverage_share": q_coverage_share,
    "coverage_share_elapsed": q_coverage_share_elapsed,
    "cluster_cost": q_cluster_cost,
    "kmeans_sweep": q_kmeans_sweep,
    "bisecting_sweep": q_bisecting_sweep,
    "model_report": q_model_report,
    "cells_q1": q_cells_q1,
    "full_run_cells_q1": q_full_run_cells_q1,
    "cells_q2": q_cells_q2,
    "cells_q3_share": q_cells_q3_share,
    "cells_q3_model": q_cells_q3_model,
    "cells_q3_cluster": q_cells_q3_cluster,
    "cells_put": q_cells_put,
    "cells_latest": q_cells_latest,
    "cells_history": q_cells_history,
    "cells_deleted": q_cells_deleted,
    "cells_scan": q_cells_scan,
    "cells_history_map": q_cells_history_map,
    "cells_stored_put": q_cells_stored_put,
    "cells_stored_get": q_cells_stored_get,
    "cells_stored_deleted": q_cells_stored_deleted,
    "csv_rejects": q_csv_rejects,
    "stream_rejects": q_stream_rejects,
    "smart_days": q_smart_days,
    "previewed": q_previewed,
    "position_scan": q_position_scan,
    "csv_round_trip": q_csv_round_trip,
    "compacted": q_compacted,
    "stream_ingested": q_stream_ingested,
    "predict_area_float": q_predict_area_float,
}
