"""Clustering: costs, repeatability, relabelling, bisecting iteration budget."""

import pytest
from pyspark.sql import functions as F

from regioncast.operators.clustering import (
    bisecting_fit,
    cluster_cost,
    kmeans_fit,
    kmeans_sweep,
    vectors,
)

# The published predicted shares on 1 June (21 areas) and the
# published k-means cost for k = 2 (a local optimum; Spark's k-means with
# seed 1 lands on the same clustering).
PUBLISHED_SHARES = [
    ("Abruzzo", 0.6240554410950037),
    ("Basilicata", 0.6051948668593938),
    ("Calabria", 0.5712403500400484),
    ("Campania", 0.5954485040650492),
    ("Emilia-Romagna", 0.6052926196517011),
    ("Friuli-Venezia Giulia", 0.6227763350748653),
    ("Lazio", 0.5962082898953223),
    ("Liguria", 0.6387745437324688),
    ("Lombardia", 0.6122205174841115),
    ("Marche", 0.6094653944369478),
    ("Molise", 0.6511480473584288),
    ("Piemonte", 0.5977693583980193),
    ("Provincia Autonoma Bolzano / Bozen", 0.6061156235069278),
    ("Provincia Autonoma Trento", 0.5537747019247538),
    ("Puglia", 0.6102536560993814),
    ("Sardegna", 0.5728542601949037),
    ("Sicilia", 0.5387801711921562),
    ("Toscana", 0.5906350377678362),
    ("Umbria", 0.6172855205644309),
    ("Valle d'Aosta / Vallée d'Aoste", 0.6058275152346745),
    ("Veneto", 0.5886861758372518),
]
PUBLISHED_COST_K2 = 0.0058632785163277735

SCHEMA = "regione string, predizione_percentuale_vaccini double"


@pytest.fixture(scope="module")
def shares(spark):
    return spark.createDataFrame(PUBLISHED_SHARES, SCHEMA)


def test_sweep_shape_cost_and_repeatability(spark, shares):
    clusters, report = kmeans_sweep(shares, "regione", "predizione_percentuale_vaccini")
    rep = {(r.modello, r.k): r for r in report.collect()}
    assert set(rep) == {(m, k) for m in ("K-MEANS", "K-MEANS-BISECTING") for k in (2, 3, 4, 5)}
    assert rep[("K-MEANS", 2)].cost_WSSSE == pytest.approx(PUBLISHED_COST_K2, rel=1e-9)
    assert clusters.count() == 8 * 21
    again, _ = kmeans_sweep(shares, "regione", "predizione_percentuale_vaccini")
    key = ["modello", "k", "regione", "cluster"]
    assert sorted(clusters.select(*key).collect()) == sorted(again.select(*key).collect())


def test_cluster_cost_matches_training_cost(spark, shares):
    clusters, report = kmeans_sweep(shares, "regione", "predizione_percentuale_vaccini")
    data = vectors(clusters, ["percentuale_vaccinati"])
    costs = (cluster_cost(data, "features", "cluster").groupBy().agg(F.sum("cost").alias("c")))
    for r in report.collect():
        got = cluster_cost(vectors(clusters.where((F.col("modello") == r.modello) & (F.col("k") == r.k)),
                                   ["percentuale_vaccinati"]), "features", "cluster").agg(F.sum("cost")).first()[0]
        assert got == pytest.approx(r.cost_WSSSE, rel=1e-9)
    assert costs.first()["c"] > 0


def test_cluster_cost_on_array_labels(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0]), (0, [2.0, 0.0]), (1, [5.0, 5.0])], "label int, e array<float>")
    got = {r.label: (r.n_points, r.cost) for r in cluster_cost(df, "e", "label").collect()}
    assert got == {0: (2, 2.0), 1: (1, 0.0)}


def test_clusters_numbered_by_ascending_centre(spark, shares):
    clusters, _ = kmeans_sweep(shares, "regione", "predizione_percentuale_vaccini", ks=(3,), models=("K-MEANS",))
    by_cluster = {}
    for r in clusters.collect():
        by_cluster.setdefault(r.cluster, []).append(r.percentuale_vaccinati)
    means = [sum(v) / len(v) for _, v in sorted(by_cluster.items())]
    assert means == sorted(means)


def test_bisecting_runs_one_fit_with_its_budget(spark, shares):
    data = vectors(shares, ["predizione_percentuale_vaccini"])
    assert bisecting_fit(data, 3, max_iter=7).getMaxIter() == 7
    a, b = bisecting_fit(data, 4), bisecting_fit(data, 4)
    assert a.summary.trainingCost == b.summary.trainingCost and a.summary.k == 4


def test_sweep_leaves_nothing_cached(spark, shares):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    clusters, report = kmeans_sweep(shares, "regione", "predizione_percentuale_vaccini", ks=(2, 3))
    clusters.collect(), report.collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before


def test_reference_label_option_reruns_kmeans(spark, shares):
    _, report = kmeans_sweep(shares, "regione", "predizione_percentuale_vaccini", ks=(2,), bisecting="kmeans")
    costs = {r.modello: r.cost_WSSSE for r in report.collect()}
    rerun = kmeans_fit(vectors(shares, ["predizione_percentuale_vaccini"]), 2, seed=2)
    assert costs["K-MEANS-BISECTING"] == pytest.approx(rerun.summary.trainingCost, rel=1e-12)
    assert costs["K-MEANS"] == pytest.approx(PUBLISHED_COST_K2, rel=1e-9)


def test_one_dimensional_clusters_are_ordered_intervals(spark, shares):
    clusters, _ = kmeans_sweep(shares, "regione", "predizione_percentuale_vaccini")
    by_run = {}
    for r in clusters.collect():
        by_run.setdefault((r.modello, r.k), []).append((r.percentuale_vaccinati, r.cluster))
    assert len(by_run) == 8
    for (model, k), rows in by_run.items():
        labels = [c for _, c in sorted(rows)]
        assert labels == sorted(labels), (model, k, labels)
        assert set(labels) == set(range(k)), (model, k, labels)


# The published cluster labels for k = 3 of both model rows (area order as
# published) and the published costs of those two labellings.
PUBLISHED_LABELS_K3 = {
    "K-MEANS": [0, 0, 2, 0, 0, 0, 0, 1, 0, 0, 1, 0, 0, 2, 0, 2, 2, 0, 0, 0, 0],
    "K-MEANS-BISECTING": [2, 0, 1, 0, 0, 2, 0, 2, 0, 0, 2, 0, 0, 1, 0, 1, 1, 0, 2, 0, 0],
}
PUBLISHED_COST_K3 = {"K-MEANS": 0.002469450680462575, "K-MEANS-BISECTING": 0.0022296223441359785}


@pytest.mark.parametrize("model", sorted(PUBLISHED_LABELS_K3))
def test_cluster_cost_reproduces_published_cost(spark, model):
    rows = [(area, share, label) for (area, share), label in zip(PUBLISHED_SHARES, PUBLISHED_LABELS_K3[model])]
    df = vectors(spark.createDataFrame(rows, "regione string, share double, label int"), ["share"])
    total = cluster_cost(df, "features", "label").agg(F.sum("cost")).first()[0]
    assert total == pytest.approx(PUBLISHED_COST_K3[model], rel=1e-9)
