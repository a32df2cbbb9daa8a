"""Result schemas (FIXTURES.md section 2): names and types of the five results."""

from regioncast.plans.params import STAND_IN as B
from regioncast.plans.query1 import avg_daily_doses_per_centre
from regioncast.plans.query2 import top_areas_next_month
from regioncast.plans.query3 import cluster_areas, coverage_share
from regioncast.schemas import RESULTS, conform
from regioncast.sources import tables as T
from tests.conftest import SF_SMALL


def _types(df):
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def _declared(schema):
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def test_result_schemas(spark):
    q1 = avg_daily_doses_per_centre(T.daily_totals(spark, SF_SMALL), T.centres(spark, SF_SMALL),
                                    B["last_december"], B["first_june"])
    assert _types(q1) == [("mese", "string"), ("regione", "string"), ("numero_medio_vaccini", "bigint")]
    q2 = top_areas_next_month(T.doses_by_band(spark, SF_SMALL), B["first_february"], B["first_june"])
    assert _types(q2) == [("giorno", "string"), ("fascia_eta", "string"), ("regione", "string"),
                          ("predizione_vaccini", "int")]
    shares = coverage_share(T.daily_totals(spark, SF_SMALL), T.population(spark, SF_SMALL), B["first_june"])
    assert _types(shares) == [("regione", "string"), ("giorno", "string"),
                              ("predizione_percentuale_vaccini", "double")]
    clusters, report = cluster_areas(shares, ks=(2,))
    assert _types(clusters) == [("modello", "string"), ("k", "int"), ("regione", "string"),
                                ("percentuale_vaccinati", "double"), ("cluster", "int")]
    assert _types(report) == [("modello", "string"), ("k", "int"), ("performance_ms", "bigint"),
                              ("cost_WSSSE", "double")]
    assert q1.count() > 0 and q2.count() > 0 and shares.count() > 0
    for df, key in ((q1, "q1"), (q2, "q2"), (shares, "q3_share"), (clusters, "q3_cluster"), (report, "q3_model")):
        assert _types(df) == _declared(RESULTS[key])
        assert _types(conform(df, RESULTS[key])) == _declared(RESULTS[key])


def test_result_shapes_like_the_published_ones(spark):
    from tests.conftest import SF_CHECK

    q1 = avg_daily_doses_per_centre(T.daily_totals(spark, SF_CHECK), T.centres(spark, SF_CHECK),
                                    B["last_december"], B["first_june"]).collect()
    assert {r.mese for r in q1} == {"Gennaio", "Febbraio", "Marzo", "Aprile", "Maggio"}
    months = [r.mese for r in q1]
    order = ["Gennaio", "Febbraio", "Marzo", "Aprile", "Maggio"]
    assert months == sorted(months, key=order.index)          # ordered by month, then area
    q2 = top_areas_next_month(T.doses_by_band(spark, SF_CHECK), B["first_february"], B["first_june"]).collect()
    assert {r.giorno for r in q2} <= {"1 Marzo", "1 Aprile", "1 Maggio", "1 Giugno"}
    groups = {}
    for r in q2:
        groups.setdefault((r.giorno, r.fascia_eta), []).append(r.predizione_vaccini)
    assert all(1 <= len(v) <= 5 for v in groups.values())
    assert all(v == sorted(v, reverse=True) for v in groups.values())
