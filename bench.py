"""Benchmark of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 [BENCH_ROUNDS=10] python bench.py

Runs each query to completion through the ``noop`` sink (full execution, no
collect to the driver) and prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...,
 "train_ms": {"K-MEANS k=2": ms, ...},            (per model: its start and its share of the common steps; they add up)
 "train_ms_like_for_like": {...}}                 (the same with the reference's second k-means run as second model)
"""

from __future__ import annotations

import json
import os
import statistics
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from regioncast import catalog  # noqa: E402
from regioncast.plans.params import STAND_IN as B  # noqa: E402
from regioncast.plans.query3 import cluster_areas, coverage_share  # noqa: E402
from regioncast.session import ensure_checkpoint_dir, get_session  # noqa: E402
from regioncast.sources import tables as T  # noqa: E402

HEADLINE = [
    "q1_avg_daily_per_centre",
    "top5_next_month_strict",
    "top5_next_month_carryover",
    "top5_next_month_filled",
    "coverage_share",
    "cluster_cost",
    "cells_q1",
    "cells_put",
    "cells_latest",
    "cells_deleted",
]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * cpus)))
    spark = get_session(f"local[{cpus}]", app="regioncast-bench", shuffle_partitions=parts,
                        conf={"spark.driver.memory": "8g"})
    # Warm-up of the JVM (class loading, JIT) on the smallest data set, not
    # the measured one; not timed.
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        _run(catalog.QUERIES["q1_avg_daily_per_centre"](spark, warm))
        _run(catalog.QUERIES["top5_next_month_strict"](spark, warm))
        warm_shares = coverage_share(T.daily_totals(spark, warm), T.population(spark, warm), B["first_june"],
                                     ordered=False)
        _run(cluster_areas(warm_shares, ks=(2,))[0])
    else:
        T.table(spark, sf_dir, "nation").count()

    # BENCH_ROUNDS > 1 repeats the headline queries (as the reference's timing
    # tool does with ten rounds) and reports each query's median.
    rounds = max(1, int(os.environ.get("BENCH_ROUNDS", "1")))
    samples: dict[str, list[float]] = {name: [] for name in HEADLINE}
    for _ in range(rounds):
        for name in HEADLINE:
            t0 = time.perf_counter()
            _run(catalog.QUERIES[name](spark, sf_dir))
            samples[name].append(time.perf_counter() - t0)
    times: dict[str, float] = {name: round(statistics.median(v), 3) for name, v in samples.items()}

    # Query 3 end to end: shares, then the eight model fits and their labels.
    t0 = time.perf_counter()
    shares = coverage_share(T.daily_totals(spark, sf_dir), T.population(spark, sf_dir), B["first_june"],
                            ordered=False)
    clusters, _ = cluster_areas(shares)
    _run(clusters)
    times["q3_cluster_sweep"] = round(time.perf_counter() - t0, 3)
    # Not part of the total: the time of each fit in the common sweep, with bisecting k-means and with the models that
    # the reference's rows were made with.
    ensure_checkpoint_dir(spark)
    fixed = shares.checkpoint(eager=True)
    own, same = (cluster_areas(fixed, bisecting=b)[1].collect() for b in ("bisecting", "kmeans"))
    train_ms, like_for_like = ({f"{r.modello} k={r.k}": r.performance_ms for r in rows} for rows in (own, same))

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "rounds": rounds, "train_ms": train_ms,
                      "train_ms_like_for_like": like_for_like}))
    spark.stop()


if __name__ == "__main__":
    main()
