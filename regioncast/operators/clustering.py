"""Clustering of areas (M1-M8).

``kmeans_fit`` and ``bisecting_fit`` are single fits by Spark ML.  ``kmeans_sweep`` fits every (model, k)
together: each step is one pass over the checkpointed input that assigns every point in all fits at once and
aggregates by (fit, cluster).  The driver only sees centres, sizes and costs.  Cluster
numbers from k-means are arbitrary, so they are renumbered by ascending
centre (B11) and a fixed seed makes runs repeatable.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from regioncast.operators.accounting import group_counts, job_group
from regioncast.session import ensure_checkpoint_dir

REPORT_SCHEMA = StructType([
    StructField("modello", StringType(), False),
    StructField("k", IntegerType(), False),
    StructField("performance_ms", LongType(), False),
    StructField("cost_WSSSE", DoubleType(), False),
])

#: What each fit of a sweep took: passes over the input, Spark jobs and tasks, and the job groups they ran in.
ACCOUNT_SCHEMA = StructType([
    StructField("modello", StringType(), False),
    StructField("k", IntegerType(), False),
    StructField("steps", IntegerType(), False),
    StructField("jobs", IntegerType(), False),
    StructField("tasks", IntegerType(), False),
    StructField("wall_ms", LongType(), False),
    StructField("groups", ArrayType(StringType(), False), False),
])

KMEANS, BISECTING = "K-MEANS", "K-MEANS-BISECTING"


def vectors(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Dense feature vectors from numeric columns (M1)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df)


def kmeans_fit(df: DataFrame, k: int, max_iter: int = 100, seed: int = 1, features: str = "features"):
    """k-means with the k-means|| start (M2)."""
    return KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol=features).fit(df)


def bisecting_fit(df: DataFrame, k: int, max_iter: int = 20, seed: int = 1, features: str = "features"):
    """Bisecting k-means with ``max_iter`` iterations per split (M3); Spark runs all of them at every split.  20 is Spark's own default."""
    return BisectingKMeans(k=k, maxIter=max_iter, seed=seed, featuresCol=features).fit(df)


def centre_order(centers) -> list[int]:
    """New number of each old cluster: rank of its centre in ascending order."""
    order = sorted(range(len(centers)), key=lambda i: tuple(float(v) for v in centers[i]))
    rank = [0] * len(centers)
    for new, old in enumerate(order):
        rank[old] = new
    return rank


def kmeans_assign(model, df: DataFrame, out: str = "cluster") -> DataFrame:
    """Assign each row to a cluster, numbered by ascending centre (M5)."""
    rank = centre_order(model.clusterCenters())
    pred_col = model.getPredictionCol()
    lookup = F.array(*[F.lit(r) for r in rank])
    assigned = model.transform(df)
    return assigned.withColumn(out, F.element_at(lookup, F.col(pred_col) + 1).cast("int")).drop(pred_col)


def cluster_cost(df: DataFrame, features: str, label: str) -> DataFrame:
    """Within-cluster sum of squares per given label (M4): label, n_points, cost.

    ``features`` may be an array column or a vector column.  One pass: a
    ``Summarizer`` aggregate per label yields the count and the per-dimension
    sample variance (merged from partial per-task states, numerically stable),
    and the sum of squared distances to the label's mean is
    ``(n - 1) * sum(variance)``.  There is no join and no per-row distance
    computation, and a label holding a third of the rows is merged from
    per-task partial states like any other.
    """
    is_array = dict(df.dtypes)[features].startswith("array")
    vec = array_to_vector(F.col(features)) if is_array else F.col(features)
    stats = df.groupBy(label).agg(Summarizer.metrics("count", "variance").summary(vec).alias("_s"))
    variance_sum = F.aggregate(vector_to_array(F.col("_s.variance")), F.lit(0.0), lambda acc, v: acc + v)
    n = F.col("_s.count")
    return stats.select(label, n.alias("n_points"), ((n - 1).cast("double") * variance_sum).alias("cost"))


def _doubles(values) -> str:
    """SQL of an array of doubles, or of nested arrays of them.  Folded to one literal, it reaches the tasks by
    reference, so a step with other centres needs no new code."""
    if isinstance(values, (list, tuple, np.ndarray)):
        return f"array({', '.join(map(_doubles, values))})"
    return f"{float(values)!r}D"


def _nearest(centres: str) -> str:
    """SQL of (d, i): squared distance of the point ``x`` to, and place of, the nearest of an array of centres; ties go to the first."""
    square = "aggregate(zip_with(x, c, (a, b) -> (a - b) * (a - b)), 0D, (s, v) -> s + v)"
    return f"array_min(transform({centres}, (c, i) -> named_struct('d', {square}, 'i', i)))"


@dataclass
class _Lloyd:
    """One set of centres on its way to a fixed point: a k-means fit, or the split of a node of the bisecting tree."""

    centres: np.ndarray
    bound: int
    steps: int = 0
    settled: bool = False
    sizes: np.ndarray | None = None
    costs: np.ndarray | None = None
    groups: list[str] = field(default_factory=list)
    wall: float = 0.0

    def update(self, rows, tol: float) -> None:
        """Move each centre to the mean of its points (one without points stays); costs are about the means."""
        new, self.sizes, self.costs = self.centres.copy(), np.zeros(len(self.centres)), np.zeros(len(self.centres))
        for r in rows:
            new[r.i] = np.array(r.sums) / r.n
            self.sizes[r.i] = r.n
            self.costs[r.i] = max(0.0, r.cost - r.n * float(((new[r.i] - self.centres[r.i]) ** 2).sum()))
        moved = np.abs(new - self.centres).max()
        self.centres, self.steps = new, self.steps + 1
        self.settled = bool(moved <= tol * (1.0 + np.abs(new).max()))

    @property
    def open(self) -> bool:
        return not self.settled and self.steps < self.bound


class _Bisecting:
    """The tree that all bisecting fits share: a split doesn't depend on k, only which nodes are split does.

    Nodes are numbered from 1, the children of i are 2 i and 2 i + 1.
    """

    def __init__(self, centre: np.ndarray, size: float, cost: float, bound: int, seed: int):
        self.centre, self.size, self.cost = {1: centre}, {1: size}, {1: cost}
        self.bound, self.seed, self.splits = bound, seed, {}

    def leaves(self, k: int) -> tuple[list[int], list[int]]:
        """The leaves of the fit with k clusters, and the nodes that must be split first.

        Level by level all divisible nodes of the last level are split, the larger ones if fewer are needed.
        """
        done, level, needed = [], [1], k - 1
        while needed > 0:
            able = [i for i in level if self.size[i] > 1 and self.cost[i] > np.finfo(float).eps * self.size[i]]
            able = sorted(able, key=lambda i: (-self.size[i], i))[:needed]
            if not able:
                break
            missing = [i for i in able if i not in self.splits or self.splits[i].open]
            if missing:
                return [], missing
            done += [i for i in level if i not in able]
            level = [c for i in sorted(able) for c in (2 * i, 2 * i + 1) if self.size[c]]
            needed -= len(able)
        return done + level, []

    def start(self, node: int) -> None:
        """Two centres beside the node's own, moved apart by a ten-thousandth of its length (in one dimension any such pair parts the points at the mean)."""
        c = self.centre[node]
        noise = 1e-4 * (np.linalg.norm(c) or 1.0) * np.random.default_rng([self.seed, node]).uniform(0.1, 1.0, len(c))
        self.splits[node] = _Lloyd(np.stack([c - noise, c + noise]), self.bound)

    def close(self, node: int) -> None:
        split = self.splits[node]
        for side in (0, 1):
            i = 2 * node + side
            self.centre[i], self.size[i], self.cost[i] = split.centres[side], split.sizes[side], split.costs[side]

    def place(self, at: set[int], found, node: int = 1) -> str:
        """SQL of ``found(node)`` for the node of ``at`` that a point comes to, going from the root to the nearer child; null if there is none."""
        if node in at:
            return found(node)
        split = self.splits.get(node)
        if split is None or split.open:
            return "NULL"
        left, right = self.place(at, found, 2 * node), self.place(at, found, 2 * node + 1)
        return f"CASE WHEN {_nearest(_doubles(split.centres))}.i = 0 THEN {left} ELSE {right} END"


@dataclass
class Sweep:
    """``clusters`` and ``report`` as of `kmeans_sweep`; ``accounts`` tells what each fit took (`ACCOUNT_SCHEMA`).

    ``clusters`` also has ``node``: the leaf of the bisecting tree that a point belongs to, 0 in a k-means fit.
    """

    clusters: DataFrame
    report: DataFrame
    accounts: DataFrame


def sweep(points: DataFrame, key: str, values: Sequence[str], ks: Sequence[int] = (2, 3, 4, 5),
          models: Sequence[str] = (KMEANS, BISECTING), seed: int = 1, max_iter: int = 100, bisecting: str = "bisecting",
          split_iter: int = 100, tol: float = 1e-12, checkpoint: bool = True, parallel_fits: int = 4) -> Sweep:
    """Fit every (model, k) on points of one or more dimensions, all fits together.

    k-means starts from Spark's k-means|| centres (``parallel_fits`` starts at a time, their common time divided).  Then every step is one pass for all fits: the assignment is a column
    expression over the centres, and one aggregate by (fit, cluster) brings counts, sums and costs.  A fit
    leaves once no centre moves by more than ``tol`` of its size (a fixed point), or after ``max_iter`` steps.  The bisecting fits
    share one tree; a split is itself such a two-centre fit with at most ``split_iter`` steps.
    A step's time is divided among the fits that took part in it.
    """
    spark = points.sparkSession
    for m in models:
        if m not in (KMEANS, BISECTING):
            raise ValueError(f"unknown model {m!r}")
    data = vectors(points.select(key, *values), list(values)).withColumn("x", F.array(*(F.col(v).cast("double") for v in values)))
    if checkpoint:
        ensure_checkpoint_dir(spark)
        data = data.checkpoint(eager=True)
    held = data.persist()
    tag = uuid.uuid4().hex[:8]
    fits = [(m, int(k)) for k in ks for m in models]
    # the reference's "bisecting" model is a second, independent k-means run
    seeds = {(m, k): seed + (m == BISECTING) for m, k in fits if m == KMEANS or bisecting == "kmeans"}
    grown = sorted(k for m, k in fits if (m, k) not in seeds)
    runs: dict[tuple[str, int], _Lloyd] = {}
    spent: dict[tuple[str, int], list] = {f: [0.0, 0, []] for f in fits}  # wall seconds, steps, job groups

    def start(fit):
        name = f"{tag}-start-{fit[0]}-{fit[1]}"
        with job_group(spark, name, f"k-means start of {fit}"):
            centres = KMeans(k=fit[1], maxIter=0, seed=seeds[fit], featuresCol="features").fit(held).clusterCenters()
        return fit, np.array(centres, dtype=float), name

    began = time.perf_counter()
    with ThreadPoolExecutor(max_workers=max(1, min(len(seeds) or 1, parallel_fits))) as pool:
        started = list(pool.map(start, seeds))
    for fit, centres, name in started:
        runs[fit] = _Lloyd(centres, max_iter)
        spent[fit][0] += (time.perf_counter() - began) / len(started)
        spent[fit][2].append(name)

    tree = None
    if grown:
        began, name = time.perf_counter(), f"{tag}-root"
        with job_group(spark, name, "all points as one cluster"):
            dims = range(len(values))
            row = held.agg(F.count("*").alias("n"), *(F.avg(F.col("x")[i]).alias(f"m{i}") for i in dims),
                           *(F.var_pop(F.col("x")[i]).alias(f"v{i}") for i in dims)).first()
        if row.n:
            tree = _Bisecting(np.array([row[f"m{i}"] for i in dims]), row.n, row.n * sum(row[f"v{i}"] for i in dims), split_iter, seed)
        for k in grown:
            spent[BISECTING, k][0] += (time.perf_counter() - began) / len(grown)
            spent[BISECTING, k][2].append(name)

    def wanted() -> dict[int, list[int]]:
        """Nodes that must be split now, with the fits that need them."""
        need: dict[int, list[int]] = {}
        for k in grown if tree else ():
            for node in tree.leaves(k)[1]:
                need.setdefault(node, []).append(k)
        return need

    number = 0
    while True:
        moving = [f for f, run in runs.items() if run.open]
        splits = wanted()
        for node in splits:
            if node not in tree.splits:
                tree.start(node)
        if not moving and not splits:
            break
        began, number, name = time.perf_counter(), number + 1, f"{tag}-step-{number + 1}"
        rows = _step(spark, held, [runs[f].centres for f in moving], tree, sorted(splits), len(values), name)
        for i, f in enumerate(moving):
            runs[f].update(rows.get(i, []), tol)
        for node in splits:
            tree.splits[node].update(rows.get(-node, []), tol)
            if not tree.splits[node].open:
                tree.close(node)
        parts = moving + [(BISECTING, k) for k in sorted({k for need in splits.values() for k in need})]
        for f in parts:
            spent[f][0] += (time.perf_counter() - began) / len(parts)
            spent[f][1] += 1
            spent[f][2].append(name)

    late = [f for f, run in runs.items() if not run.settled]  # stopped by the bound: points may be nearer to another centre now
    if late:
        rows = _step(spark, held, [runs[f].centres for f in late], None, [], len(values), f"{tag}-last")
        for i, f in enumerate(late):
            runs[f].costs = np.array([r.cost for r in rows.get(i, [])])
    held.unpersist()

    labels, report, accounts = [], [], []
    for f in fits:
        if f in runs:
            rank = ", ".join(map(str, centre_order(runs[f].centres)))
            cluster, cost = f"array({rank})[{_nearest(_doubles(runs[f].centres))}.i]", float(runs[f].costs.sum())
            node = "0"
        else:
            leaves = tree.leaves(f[1])[0] if tree else [1]
            ranks = dict(zip(leaves, centre_order([tree.centre[i] for i in leaves] if tree else [[0.0]])))
            cluster = tree.place(set(leaves), lambda i, ranks=ranks: str(ranks[i])) if tree else "0"
            node = tree.place(set(leaves), str) if tree else "1"
            cost = float(sum(tree.cost[i] for i in leaves)) if tree else 0.0
        labels.append(F.expr(f"named_struct('modello', '{f[0]}', 'k', {f[1]}, 'cluster', {cluster}, 'node', bigint({node}))"))
        wall, steps, groups = spent[f]
        jobs, tasks = (sum(c) for c in zip(*(group_counts(spark, g) for g in groups)))
        report.append((f[0], f[1], int(round(1000 * wall)), cost))
        accounts.append((f[0], f[1], steps, jobs, tasks, int(round(1000 * wall)), groups))
    clusters = data.select(key, *values, F.explode(F.array(*labels)).alias("fit")).select(
        "fit.modello", "fit.k", key, *(F.col(v).cast("double").alias(v) for v in values), "fit.cluster", "fit.node")
    return Sweep(clusters, spark.createDataFrame(report, REPORT_SCHEMA), spark.createDataFrame(accounts, ACCOUNT_SCHEMA))


def _step(spark, held: DataFrame, centres: list[np.ndarray], tree, splits: list[int], dims: int, name: str) -> dict[int, list]:
    """One pass: rows (i, n, sums, cost) by fit (its place in ``centres``, or the negative number of the node that is split)."""
    found = []
    if centres:
        nearest = f"transform({_doubles(centres)}, cs -> {_nearest('cs')})"
        found.append(f"transform({nearest}, (b, g) -> named_struct('g', g, 'i', b.i, 'd', b.d))")
    if splits:
        def child(node):
            near = _nearest(_doubles(tree.splits[node].centres))
            return f"named_struct('g', {-node}, 'i', {near}.i, 'd', {near}.d)"

        found.append(f"array({tree.place(set(splits), child)})")
    every = f"concat({', '.join(found)})" if len(found) > 1 else found[0]
    sums = ", ".join(f"sum(x[{j}])" for j in range(dims))
    with job_group(spark, name, "one step of all open fits"):
        rows = held.select("x", F.expr(f"explode({every})").alias("a")).where("a IS NOT NULL").groupBy("a.g", "a.i").agg(
            F.expr("count(*) AS n"), F.expr(f"array({sums}) AS sums"), F.expr("sum(a.d) AS cost")).collect()
    out: dict[int, list] = {}
    for r in rows:
        out.setdefault(r.g, []).append(r)
    return out


def kmeans_sweep(points: DataFrame, key: str, value: str, ks: Sequence[int] = (2, 3, 4, 5),
                 models: Sequence[str] = (KMEANS, BISECTING), seed: int = 1,
                 max_iter: int = 100, bisecting: str = "bisecting", split_iter: int = 100,
                 checkpoint: bool = True, parallel_fits: int = 4) -> tuple[DataFrame, DataFrame]:
    """Fit every (model, k) on 1-D points; return (clusters, report).

    clusters: modello, k, regione, percentuale_vaccinati, cluster
    report:   modello, k, performance_ms, cost_WSSSE

    See `sweep`: at most ``max_iter`` steps of a k-means fit and ``split_iter`` of each bisecting split; both stop earlier at a
    fixed point.  ``performance_ms`` is a fit's start and its share of the common steps, so the rows add up to the time of the sweep.

    The input is checkpointed to the shared checkpoint folder, so the
    steps re-read a short lineage even after an executor is lost, and kept in memory
    while they run.  ``parallel_fits`` is the number of k-means starts computed at once.
    """
    got = sweep(points, key, [value], ks, models, seed, max_iter, bisecting, split_iter, checkpoint=checkpoint, parallel_fits=parallel_fits)
    clusters = got.clusters.select("modello", "k", F.col(key).alias("regione"), F.col(value).alias("percentuale_vaccinati"), "cluster")
    return clusters, got.report
