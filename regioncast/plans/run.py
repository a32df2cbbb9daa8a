"""Full run (Z5): the three queries, their saved results, then the cell exports.

Like the reference, the exports read the saved results back, so each export
starts from a short lineage (a written table in the shared folder) instead
of recomputing the queries.
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regioncast.operators.filters import unreadable_days
from regioncast.plans.exports import (
    TABLES,
    export_q1_cells,
    export_q2_cells,
    export_q3_cluster_cells,
    export_q3_model_cells,
    export_q3_share_cells,
)
from regioncast.plans.params import KS, MIN_DAYS, REFERENCE, TOP_N
from regioncast.plans.query1 import avg_daily_doses_per_centre
from regioncast.plans.query2 import top_areas_next_month
from regioncast.plans.query3 import cluster_areas, coverage_share
from regioncast.schemas import RESULTS, conform
from regioncast.sinks.files import compact, write_cells, write_csv, write_result
from regioncast.sources.files import read_result


def run_all(spark: SparkSession, inputs: dict[str, DataFrame], out: str,
            bounds: dict[str, str] = REFERENCE, mode: str = "strict", zero_fill: bool = False,
            seed: int = 1, export: bool = True, debug_csv: bool = False,
            ts: int | None = None, queries: tuple[str, ...] = ("q1", "q2", "q3"),
            parse_mode: str = "strict", x_mode: str = "dayofyear", top_n: int = TOP_N,
            min_days: int = MIN_DAYS, ks: tuple[int, ...] = KS, bisecting: str = "bisecting") -> dict[str, str]:
    """Run queries 1-3 (or the ones named in ``queries``) on ``inputs``
    (daily_totals, centres, doses_by_band, population) and write everything
    under ``out``; return the paths.

    bounds      the three date bounds (``params.REFERENCE`` or ``params.STAND_IN``)
    mode        query 2 month rule: ``strict`` or ``carryover``
    zero_fill   fill missing days with 0 before the query 2 fit
    min_days    non-zero days a month needs (query 2)
    top_n       areas kept per (month, band) (query 2)
    x_mode      regression day number: ``dayofyear`` or ``elapsed``
    parse_mode  day text parsing: ``strict``, ``lenient`` (rows with unreadable days are left out and
                counted in ``unreadable_days``) or ``smart``
    ks, seed, bisecting   the clustering sweep (query 3)
    export      write the five cell tables; ``ts`` is their version (default: now, in ms)
    debug_csv   also write CSV copies of the results
    """
    out = out.rstrip("/")
    paths: dict[str, str] = {}
    names: dict[str, str] = {}

    if parse_mode == "lenient":
        # Rows left out for an unreadable day, counted per input.
        counts = [unreadable_days(inputs[k]).agg(F.count("*").alias("rows")).select(F.lit(k).alias("input"), "rows")
                  for k in ("daily_totals", "doses_by_band") if k in inputs]
        paths["unreadable_days"] = write_result(reduce(DataFrame.unionByName, counts), out, "unreadable_days")

    if "q1" in queries:
        q1 = avg_daily_doses_per_centre(inputs["daily_totals"], inputs["centres"],
                                        bounds["last_december"], bounds["first_june"], parse_mode=parse_mode)
        paths["q1"] = write_result(conform(q1, RESULTS["q1"]), out, names.setdefault("q1", "query1_results"))

    if "q2" in queries:
        q2 = top_areas_next_month(inputs["doses_by_band"], bounds["first_february"], bounds["first_june"],
                                  mode=mode, min_days=min_days, zero_fill=zero_fill, n=top_n,
                                  parse_mode=parse_mode, x_mode=x_mode)
        paths["q2"] = write_result(conform(q2, RESULTS["q2"]), out, names.setdefault("q2", "query2_results"))

    if "q3" in queries:
        shares = coverage_share(inputs["daily_totals"], inputs["population"], bounds["first_june"],
                                parse_mode=parse_mode, x_mode=x_mode)
        paths["q3_share"] = write_result(conform(shares, RESULTS["q3_share"]), out,
                                         names.setdefault("q3_share", "query3_results"))
        saved_shares = read_result(spark, "query3_results", out)
        clusters, report = cluster_areas(saved_shares, ks=ks, seed=seed, bisecting=bisecting)
        paths["q3_model"] = write_result(conform(report, RESULTS["q3_model"]), out,
                                         names.setdefault("q3_model", "query3_performance"))
        # The reference appends the eight cluster tables to a staging folder and
        # compacts them; one union and one write do the same, and
        # overwriting (not appending) keeps a re-run from duplicating rows.
        staging = write_result(conform(clusters, RESULTS["q3_cluster"]), out, "query3_cluster_staging")
        compact(spark, staging, f"{out}/query3_cluster")
        paths["q3_cluster"] = f"{out}/{names.setdefault('q3_cluster', 'query3_cluster')}"

    if debug_csv:
        for key, name in names.items():
            write_csv(spark.read.parquet(paths[key]), f"{out}/csv", name)

    if export:
        stamp = int(time.time() * 1000) if ts is None else ts
        exporters = {
            "q1": export_q1_cells, "q2": export_q2_cells, "q3_share": export_q3_share_cells,
            "q3_model": export_q3_model_cells, "q3_cluster": export_q3_cluster_cells,
        }
        for key, fn in exporters.items():
            if key in paths:
                cells = fn(spark.read.parquet(paths[key]), stamp)
                paths[f"cells_{key}"] = write_cells(cells, f"{out}/cells", TABLES[key])
    return paths


def main(argv: list[str] | None = None) -> None:
    """``python -m regioncast.plans.run INPUT_DIR OUTPUT_DIR [--debug] [--mode carryover] [--zero-fill] [--only q1,q2]``

    Reads the four input files by position, runs the three queries and
    writes results and cell tables under OUTPUT_DIR.  ``--debug`` also
    writes CSV copies and skips the cell export, as the reference's debug
    flag does.
    """
    import argparse

    from regioncast.session import get_session
    from regioncast.sources.files import read_inputs

    ap = argparse.ArgumentParser(prog="regioncast.plans.run")
    ap.add_argument("input_dir")
    ap.add_argument("output_dir")
    ap.add_argument("--debug", action="store_true")
    ap.add_argument("--mode", choices=("strict", "carryover"), default="strict")
    ap.add_argument("--zero-fill", action="store_true")
    ap.add_argument("--seed", type=int, default=1)
    ap.add_argument("--only", default="q1,q2,q3", help="comma-separated subset of q1,q2,q3")
    ap.add_argument("--parse-mode", choices=("strict", "lenient", "smart"), default="strict",
                    help="day text parsing: fail, NULL, or clamp past-month-end days as the reference")
    ap.add_argument("--x-mode", choices=("dayofyear", "elapsed"), default="dayofyear",
                    help="regression day number: day of year (as the reference) or days since 1970-01-01")
    ap.add_argument("--top-n", type=int, default=TOP_N, help="areas kept per month and band in query 2")
    ap.add_argument("--min-days", type=int, default=MIN_DAYS, help="non-zero days a month needs in query 2")
    ap.add_argument("--ks", default=",".join(str(k) for k in KS), help="cluster counts swept in query 3")
    ap.add_argument("--bisecting", choices=("bisecting", "kmeans"), default="bisecting",
                    help="second model: Spark's bisecting k-means, or a second k-means run as the reference")
    for key, day in REFERENCE.items():
        ap.add_argument("--" + key.replace("_", "-"), default=day, help=f"date bound (default {day})")
    args = ap.parse_args(argv)
    bounds = {key: getattr(args, key) for key in REFERENCE}
    spark = get_session()
    paths = run_all(spark, read_inputs(spark, args.input_dir), args.output_dir, bounds=bounds, mode=args.mode,
                    zero_fill=args.zero_fill, seed=args.seed, export=not args.debug, debug_csv=args.debug,
                    queries=tuple(q.strip() for q in args.only.split(",") if q.strip()),
                    parse_mode=args.parse_mode, x_mode=args.x_mode, top_n=args.top_n, min_days=args.min_days,
                    ks=tuple(int(k) for k in args.ks.split(",") if k.strip()), bisecting=args.bisecting)
    for key, path in paths.items():
        print(f"{key}\t{path}")
    spark.stop()


if __name__ == "__main__":
    main()
