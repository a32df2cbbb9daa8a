"""The common sweep: against single fits by Spark ML, its stop rule, and what each fit took."""

import json
import subprocess
import sys
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from regioncast.operators.accounting import group_counts, job_group, task_times, with_task_time
from regioncast.operators.clustering import bisecting_fit, kmeans_fit, sweep, vectors
from tests.test_clustering import PUBLISHED_SHARES

# Costs of the separate Spark ML fits (seed 1, bisecting with 100 iterations) on the published shares.
SEPARATE = {
    ("K-MEANS", 2): 0.005863278516327774, ("K-MEANS", 3): 0.0032136542641648287, ("K-MEANS", 4): 0.0013862530330394033,
    ("K-MEANS", 5): 0.000766224812581383, ("K-MEANS-BISECTING", 2): 0.00586327851632884, ("K-MEANS-BISECTING", 3): 0.004165585101359337,
    ("K-MEANS-BISECTING", 4): 0.0015072125473656328, ("K-MEANS-BISECTING", 5): 0.001417469639208413,
}


def costs(got):
    return {(r.modello, r.k): r.cost_WSSSE for r in got.report.collect()}


def test_same_clusters_as_separate_fits(spark):
    got = costs(sweep(spark.createDataFrame(PUBLISHED_SHARES, "area string, share double"), "area", ["share"]))
    assert got == {f: pytest.approx(c, rel=1e-9) for f, c in SEPARATE.items()}


def test_several_dimensions(spark):
    rng = np.random.default_rng(3)
    rows = [(i, *map(float, rng.normal(size=2) + 8 * np.array([i % 2, i % 4 // 2]))) for i in range(400)]
    points = spark.createDataFrame(rows, "id long, a double, b double").repartition(5)
    got = sweep(points, "id", ["a", "b"], ks=(2, 4))
    data = vectors(points, ["a", "b"])
    assert costs(got)["K-MEANS", 4] == pytest.approx(kmeans_fit(data, 4, seed=1).summary.trainingCost, rel=1e-6)
    assert costs(got)["K-MEANS-BISECTING", 4] == pytest.approx(bisecting_fit(data, 4, max_iter=100).summary.trainingCost, rel=1e-6)
    labels = got.clusters.where("modello = 'K-MEANS-BISECTING' AND k = 4").groupBy("cluster").agg(
        F.countDistinct(F.col("id") % 4).alias("kinds"), F.count("*").alias("n")).collect()
    assert [(r.kinds, r.n) for r in labels] == [(1, 100)] * 4


def slow_points():
    """A long even stretch and a far tail: the bound between two sides creeps."""
    return [(i, float(1.02 ** i)) for i in range(400)]


def test_splits_run_until_they_settle(spark):
    points = spark.createDataFrame(slow_points(), "id long, v double")
    few, enough, more = (sweep(points, "id", ["v"], ks=(2, 3), models=("K-MEANS-BISECTING",), split_iter=n) for n in (3, 100, 1000))
    assert costs(few)["K-MEANS-BISECTING", 2] > costs(enough)["K-MEANS-BISECTING", 2] * 1.0001
    assert costs(enough) == costs(more)
    steps = {r.k: r.steps for r in enough.accounts.collect()}
    assert 3 < steps[2] < 100
    spark_fit = bisecting_fit(vectors(points, ["v"]), 3, max_iter=100).summary
    assert costs(enough)["K-MEANS-BISECTING", 3] == pytest.approx(spark_fit.trainingCost, rel=1e-9)


def test_bound_below_the_fixed_point_still_costs_its_labels(spark):
    got = sweep(spark.createDataFrame(slow_points(), "id long, v double"), "id", ["v"], ks=(3,), models=("K-MEANS",), max_iter=2)
    rows = got.clusters.collect()
    by = {}
    for r in rows:
        by.setdefault(r.cluster, []).append(r.v)
    own = sum(((np.array(v) - np.mean(v)) ** 2).sum() for v in by.values())
    assert costs(got)["K-MEANS", 3] >= own * (1 - 1e-9)


def test_equal_points_cannot_be_split(spark):
    got = sweep(spark.createDataFrame([(i, 2.0) for i in range(9)], "id long, v double"), "id", ["v"], ks=(2, 3), models=("K-MEANS-BISECTING",))
    assert costs(got) == {("K-MEANS-BISECTING", 2): 0.0, ("K-MEANS-BISECTING", 3): 0.0}
    assert {r.cluster for r in got.clusters.collect()} == {0}


def test_groups_count_their_own_jobs_only(spark):
    with job_group(spark, "own-work"):
        spark.range(100, numPartitions=3).selectExpr("sum(id)").collect()
        with job_group(spark, "other-work"):
            spark.range(10, numPartitions=7).write.format("noop").mode("overwrite").save()
    spark.range(10, numPartitions=5).write.format("noop").mode("overwrite").save()
    own, other = group_counts(spark, "own-work"), group_counts(spark, "other-work")
    assert other == (1, 7) and own[0] >= 1 and own[1] >= 3
    assert group_counts(spark, "no-such-work") == (0, 0)


def test_task_time_from_the_event_log(spark, tmp_path):
    """A session of its own with an event log; its file is then read here."""
    script = textwrap.dedent(f"""
        import json
        from regioncast.session import get_session
        from regioncast.operators.accounting import job_group
        from regioncast.operators.clustering import sweep
        conf = {{"spark.eventLog.enabled": "true", "spark.eventLog.dir": "{tmp_path}", "spark.eventLog.compress": "false",
                "spark.eventLog.rolling.enabled": "false", "spark.checkpoint.dir": "{tmp_path}/ckpt"}}
        spark = get_session("local[2]", shuffle_partitions=2, conf=conf)
        got = sweep(spark.createDataFrame([(i, float(i * i)) for i in range(50)], "id long, v double"), "id", ["v"], ks=(2, 3))
        with job_group(spark, "unrelated"):
            spark.range(2_000_000, numPartitions=4).selectExpr("sum(sqrt(id))").collect()
        print("ROWS", json.dumps([list(r) for r in got.accounts.collect()]), spark.sparkContext.applicationId)
        spark.stop()
    """)
    run = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300, cwd=sys.path[0] or ".")
    line = next((x for x in run.stdout.splitlines() if x.startswith("ROWS ")), None)
    assert line, run.stderr[-3000:]
    rows, app = json.loads(line[5:line.rindex(" ")]), line.rsplit(" ", 1)[1]
    times = task_times(spark, f"file://{tmp_path}/{app}")
    by_group = {r.group: r for r in times.collect()}
    assert "unrelated" in by_group and by_group["unrelated"].tasks >= 4
    accounts = spark.createDataFrame(rows, "modello string, k int, steps int, jobs int, tasks int, wall_ms long, groups array<string>")
    timed = with_task_time(accounts, times).collect()
    assert len(timed) == 4 and all(r.task_ms > 0 for r in timed)
    groups = {g for r in timed for g in r.groups}
    assert "unrelated" not in groups
    assert abs(sum(r.task_ms for r in timed) - sum(by_group[g].task_ms for g in groups if g in by_group)) <= 4
