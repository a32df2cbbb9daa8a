"""Cell exports of the query results.

Each result becomes a cell table; ``write_cells`` stores it as Parquet.  The
reference collects every result to the driver and puts it cell by cell; here
the conversion is one ``unpivot`` per result, run by the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from regioncast.operators.cells import to_cells

# Table, family and qualifier names of the reference's exports.
TABLES = {
    "q1": "Query1_table",
    "q2": "Query2_table",
    "q3_share": "Query3_table_results",
    "q3_model": "Query3_table_performance",
    "q3_cluster": "Query3_table_cluster",
}
FAMILIES = {
    "q1": "cf1",
    "q2": "cf2",
    "q3_share": "cf3_results",
    "q3_model": "cf3_performance",
    "q3_cluster": "cf3_cluster",
}
MEDIA_VACCINATI = "media_vaccinati"
MESE = "mese"
AREA = "regione"
FASCIA_ETA = "fascia_eta"
PREDIZIONE_VACCINATI = "predizione_vaccinati"
PREDIZIONE_PERCENTUALE_VACCINATI_TOTALE = "predizione_vaccinati_totale"
COST = "cost"
PERFORMANCE = "performance_ms"
CLUSTER = "cluster"
MODEL = "modello"
N_CLUSTER = "n_cluster"


def export_q1_cells(q1: DataFrame, ts: int) -> DataFrame:
    """Key ``mese/regione``; qualifiers media_vaccinati, regione, mese."""
    return to_cells(q1, ["mese", "regione"], FAMILIES["q1"], {
        MEDIA_VACCINATI: "numero_medio_vaccini", AREA: "regione", MESE: "mese"}, ts)


def export_q2_cells(q2: DataFrame, ts: int) -> DataFrame:
    """Key ``giorno/fascia_eta/regione``; qualifier ``mese`` holds the day label."""
    return to_cells(q2, ["giorno", "fascia_eta", "regione"], FAMILIES["q2"], {
        PREDIZIONE_VACCINATI: "predizione_vaccini", MESE: "giorno",
        FASCIA_ETA: "fascia_eta", AREA: "regione"}, ts)


def export_q3_share_cells(shares: DataFrame, ts: int) -> DataFrame:
    """Key ``regione/giorno``; qualifier ``mese`` holds the day label."""
    return to_cells(shares, ["regione", "giorno"], FAMILIES["q3_share"], {
        PREDIZIONE_PERCENTUALE_VACCINATI_TOTALE: "predizione_percentuale_vaccini",
        AREA: "regione", MESE: "giorno"}, ts)


def export_q3_model_cells(report: DataFrame, ts: int) -> DataFrame:
    """Key ``modello/k``; qualifiers performance_ms, cost, modello, n_cluster."""
    return to_cells(report, ["modello", "k"], FAMILIES["q3_model"], {
        PERFORMANCE: "performance_ms", COST: "cost_WSSSE", MODEL: "modello", N_CLUSTER: "k"}, ts)


def export_q3_cluster_cells(clusters: DataFrame, ts: int) -> DataFrame:
    """Key ``modello/k/regione``; qualifiers modello, n_cluster, regione, share, cluster."""
    return to_cells(clusters, ["modello", "k", "regione"], FAMILIES["q3_cluster"], {
        MODEL: "modello", N_CLUSTER: "k", AREA: "regione",
        PREDIZIONE_PERCENTUALE_VACCINATI_TOTALE: "percentuale_vaccinati", CLUSTER: "cluster"}, ts)
