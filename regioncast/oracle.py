"""DuckDB SQL for every registered query that SQL can express.

Each statement rebuilds the stand-in views from the raw tables (views are
CTEs) and then computes the same result as ``catalog.QUERIES[name]`` with
the same column names and types.  Integer regression uses HUGEINT and
``//`` (truncating, like Spark's ``div``); an undefined float fit is NULL
in Spark and NaN in DuckDB, so the SQL maps NaN to NULL.  The k-means labels have no SQL
form (iterative, seeded); what must hold of them is checked by ``sweep_structure``.  Month names, date bounds and
repair rules are written out here, independent of the engine's own.
"""

from __future__ import annotations

_DEC, _FEB, _JUN = "1996-12-31", "1997-02-01", "1997-06-01"


def _label(expr: str) -> str:
    return (f"(CASE month({expr}) WHEN 1 THEN 'Gennaio' WHEN 2 THEN 'Febbraio' WHEN 3 THEN 'Marzo' WHEN 4 THEN 'Aprile'"
            " WHEN 5 THEN 'Maggio' WHEN 6 THEN 'Giugno' WHEN 7 THEN 'Luglio' WHEN 8 THEN 'Agosto' WHEN 9 THEN 'Settembre'"
            " WHEN 10 THEN 'Ottobre' WHEN 11 THEN 'Novembre' WHEN 12 THEN 'Dicembre' END)")


def _repair(expr: str) -> str:
    return f"CASE WHEN {expr} LIKE '%Valle%' THEN 'Valle d''Aosta / Vallée d''Aoste' ELSE {expr} END"


def _mstart(expr: str) -> str:
    return f"CAST(date_trunc('month', {expr}) AS DATE)"


VIEWS = f"""
daily_totals AS (
  SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
         CAST(SUM(CAST(FLOOR(o_totalprice) AS BIGINT)) AS BIGINT) AS total,
         n_name AS area
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY CAST(o_orderdate AS DATE), n_name),
centres AS (
  SELECT s_suppkey AS centre, n_name AS area FROM supplier JOIN nation ON s_nationkey = n_nationkey),
doses_by_band AS (
  SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, l_linestatus AS brand, l_returnflag AS band,
         CASE WHEN l_linenumber % 2 = 1 THEN CAST(l_quantity AS INTEGER) ELSE 0 END AS n, n_name AS area
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
population AS (
  SELECT n_name AS area, CAST(COUNT(*) * 1000000 AS BIGINT) AS people
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name)"""

# Query 1 pieces.
Q1_CTES = f"""
q1_rows AS (
  SELECT CAST(day AS DATE) AS d, total, area FROM daily_totals
  WHERE CAST(day AS DATE) > DATE '{_DEC}' AND CAST(day AS DATE) < DATE '{_JUN}'),
month_totals AS (
  SELECT {_mstart('d')} AS m, area, CAST(SUM(CAST(total AS BIGINT)) AS BIGINT) AS total
  FROM q1_rows GROUP BY 1, 2),
centre_counts AS (SELECT area, COUNT(*) AS centres FROM centres GROUP BY area),
q1 AS (
  SELECT {_label('mt.m')} AS mese, mt.area AS regione,
         CAST(mt.total // (CAST(dayofmonth(last_day(mt.m)) AS BIGINT) * c.centres) AS BIGINT) AS numero_medio_vaccini
  FROM month_totals mt JOIN centre_counts c ON mt.area = c.area)"""


def _forecast_sql(x0: str) -> str:
    """Exact truncated forecast from HUGEINT sums n, sx, sy, sxx, sxy."""
    den = "(n*sxx - sx*sx)"
    num = "(n*sxy - sx*sy)"
    return (f"CAST(CASE WHEN {den} = 0 THEN 0 ELSE GREATEST(0, (sy*{den} + {num}*(n*CAST({x0} AS HUGEINT) - sx))"
            f" // (n*{den})) END AS BIGINT)")


def _sums(src: str, keys: str, x: str, y: str) -> str:
    return (f"SELECT {keys}, CAST(COUNT(*) AS HUGEINT) AS n, CAST(SUM({x}) AS HUGEINT) AS sx,"
            f" CAST(SUM({y}) AS HUGEINT) AS sy, CAST(SUM(({x})*({x})) AS HUGEINT) AS sxx,"
            f" CAST(SUM(({x})*({y})) AS HUGEINT) AS sxy FROM {src} GROUP BY {keys}")


# Query 2 pieces.
Q2_CTES = f"""
q2_rows AS (
  SELECT CAST(day AS DATE) AS d, area, band, n FROM doses_by_band
  WHERE CAST(day AS DATE) >= DATE '{_FEB}' AND CAST(day AS DATE) < DATE '{_JUN}'),
daily AS (
  SELECT d, area, band, CAST(SUM(CAST(n AS BIGINT)) AS BIGINT) AS n FROM q2_rows GROUP BY d, area, band),
marked AS (
  SELECT d, area, band, n, {_mstart('d')} AS m,
         COUNT(*) FILTER (WHERE n <> 0) OVER (PARTITION BY area, band, {_mstart('d')}) >= 2 AS ok
  FROM daily),
marked2 AS (
  SELECT *, LAG(m) OVER (PARTITION BY area, band ORDER BY d) AS pm,
            LAG(ok) OVER (PARTITION BY area, band ORDER BY d) AS pok
  FROM marked),
kept_strict AS (SELECT d, area, band, n FROM marked WHERE ok),
kept_carryover AS (
  SELECT d, area, band, n FROM marked2
  WHERE CASE WHEN (pm IS NULL OR pm <> m) AND pok IS NOT NULL THEN pok ELSE ok END),
fill_months AS (SELECT DISTINCT area, band, {_mstart('d')} AS m FROM kept_strict),
fill_offsets AS (
  SELECT area, band, m, unnest(generate_series(0, dayofmonth(last_day(m)) - 1)) AS off FROM fill_months),
fill_calendar AS (SELECT area, band, CAST(m + CAST(off AS INTEGER) AS DATE) AS d FROM fill_offsets),
kept_filled AS (
  SELECT c.d, c.area, c.band, CAST(COALESCE(k.n, 0) AS BIGINT) AS n
  FROM fill_calendar c LEFT JOIN kept_strict k ON c.area = k.area AND c.band = k.band AND c.d = k.d),
cfill_months AS (SELECT DISTINCT area, band, {_mstart('d')} AS m FROM kept_carryover),
cfill_offsets AS (
  SELECT area, band, m, unnest(generate_series(0, dayofmonth(last_day(m)) - 1)) AS off FROM cfill_months),
cfill_calendar AS (SELECT area, band, CAST(m + CAST(off AS INTEGER) AS DATE) AS d FROM cfill_offsets),
kept_carryover_filled AS (
  SELECT c.d, c.area, c.band, CAST(COALESCE(k.n, 0) AS BIGINT) AS n
  FROM cfill_calendar c LEFT JOIN kept_carryover k ON c.area = k.area AND c.band = k.band AND c.d = k.d)"""


def _q2_preds(kept: str, name: str) -> str:
    pts = f"{name}_pts"
    sums = f"{name}_sums"
    return f"""
{pts} AS (
  SELECT area, band, {_mstart('d')} AS m, CAST(dayofyear(d) AS BIGINT) AS x, n AS y FROM {kept}),
{sums} AS ({_sums(pts, 'area, band, m', 'x', 'y')}),
{name} AS (
  SELECT area, band, m, CAST(last_day(m) + 1 AS DATE) AS t,
         {_forecast_sql('dayofyear(CAST(last_day(m) + 1 AS DATE))')} AS pred
  FROM {sums})"""


def _top5_select(preds: str) -> str:
    return f"""
SELECT '1 ' || {_label('t')} AS giorno, band AS fascia_eta, area AS regione,
       CAST(pred AS INTEGER) AS predizione_vaccini
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY t, band ORDER BY pred DESC, area ASC) AS rk FROM {preds})
WHERE rk <= 5"""


# Query 3 pieces.
Q3_CTES = f"""
q3_rows AS (
  SELECT area, CAST(dayofyear(CAST(day AS DATE)) AS BIGINT) AS x, CAST(total AS BIGINT) AS y
  FROM daily_totals WHERE CAST(day AS DATE) < DATE '{_JUN}'),
q3_sums AS ({_sums('q3_rows', 'area', 'x', 'y')}),
area_fc AS (
  SELECT area, CAST(sy AS BIGINT) AS total, {_forecast_sql(f"dayofyear(DATE '{_JUN}')")} AS pred FROM q3_sums),
pop AS (SELECT {_repair('area')} AS area, people FROM population),
shares AS (
  SELECT f.area AS regione, '1 ' || {_label(f"DATE '{_JUN}'")} AS giorno,
         CAST(f.total + f.pred AS DOUBLE) / CAST(p.people AS DOUBLE) AS predizione_percentuale_vaccini
  FROM area_fc f JOIN pop p ON f.area = p.area)"""

# Query 3 with days counted from 1970-01-01.
Q3E_CTES = f"""
q3e_rows AS (
  SELECT area, CAST(CAST(day AS DATE) - DATE '1970-01-01' AS BIGINT) AS x, CAST(total AS BIGINT) AS y
  FROM daily_totals WHERE CAST(day AS DATE) < DATE '{_JUN}'),
q3e_sums AS ({_sums('q3e_rows', 'area', 'x', 'y')}),
area_fc_e AS (
  SELECT area, CAST(sy AS BIGINT) AS total,
         {_forecast_sql(f"(DATE '{_JUN}' - DATE '1970-01-01')")} AS pred FROM q3e_sums),
pop_e AS (SELECT {_repair('area')} AS area, people FROM population),
shares_e AS (
  SELECT f.area AS regione, '1 ' || {_label(f"DATE '{_JUN}'")} AS giorno,
         CAST(f.total + f.pred AS DOUBLE) / CAST(p.people AS DOUBLE) AS predizione_percentuale_vaccini
  FROM area_fc_e f JOIN pop_e p ON f.area = p.area)"""

# Query 1 and query 3 rows without the days that the stand-in writes unreadably.
LENIENT_VIEW = "daily_totals AS (SELECT * FROM all_totals WHERE dayofmonth(CAST(day AS DATE)) <> 31)"

# Cells of the event stream: put in two batches, of one version the last write stays.
CELL_CTES = """
ev_cells AS (
  SELECT CAST(user_id AS VARCHAR) AS row_key, CASE WHEN event_type = 'purchase' THEN 'sales' ELSE 'web' END AS family,
         event_type AS qualifier, CAST(epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP)) // 1000 AS BIGINT) AS ts,
         CAST(value AS VARCHAR) AS value, event_id FROM events),
ev_table AS (
  SELECT row_key, family, qualifier, ts, value FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY row_key, family, qualifier, ts ORDER BY event_id % 2 DESC, event_id DESC) AS rn
    FROM ev_cells) WHERE rn = 1),
ev_latest AS (
  SELECT row_key, family, qualifier, ts, value FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY row_key, family, qualifier ORDER BY ts DESC) AS rn
    FROM ev_table) WHERE rn = 1),
ev_keys AS (SELECT DISTINCT CAST(s_suppkey AS VARCHAR) AS row_key FROM supplier)"""

_CELL_COLUMNS = "SELECT row_key, family, qualifier, ts, value FROM"


def _cells(src: str, key_cols: list[str], family: str, quals: list[tuple[str, str]], ts: int = 1) -> str:
    key = " || '/' || ".join(f"CAST({c} AS VARCHAR)" for c in key_cols)
    parts = [f"SELECT {key} AS row_key, '{q}' AS qualifier, CAST({c} AS VARCHAR) AS value FROM {src}"
             for q, c in quals]
    union = "\n  UNION ALL ".join(parts)
    return (f"SELECT row_key, '{family}' AS family, qualifier, CAST({ts} AS BIGINT) AS ts, value FROM (\n  {union})")


_RUNS = """runs AS (
  SELECT modello, k FROM (VALUES ('K-MEANS'), ('K-MEANS-BISECTING')) m(modello), (VALUES (2), (3), (4), (5)) n(k))"""


# Bisecting k-means on the shares: the two means beside a node's own settle on a bound between its sides; k = 3 and the
# last split of k = 5 take the largest leaf.
def _split(nodes: str, out: str) -> str:
    side = "list_filter(v, lambda x: x {} b)"
    return f"""
{out}_b AS (
  SELECT node, v, list_avg(v) AS b, 0 AS step, FALSE AS settled FROM {nodes}
  UNION ALL
  SELECT node, v, n, step + 1, n = b FROM (
    SELECT node, v, b, step, (list_avg({side.format('<=')}) + list_avg({side.format('>')})) / 2 AS n FROM {out}_b WHERE NOT settled AND step < 100)),
{out} AS (
  SELECT 2 * node AS node, {side.format('<=')} AS v FROM {out}_b WHERE settled
  UNION ALL SELECT 2 * node + 1, {side.format('>')} FROM {out}_b WHERE settled)"""


BISECTING_CTES = ",".join(("""
root AS (SELECT 1 AS node, list_sort(list(predizione_percentuale_vaccini)) AS v FROM shares)""", _split("root", "two"), _split("two", "four"), """
big AS (SELECT * FROM four ORDER BY len(v) DESC, node LIMIT 1)""", _split("big", "eight"), """
larger AS (SELECT node FROM two ORDER BY len(v) DESC, node LIMIT 1),
leaves AS (
  SELECT 2 AS k, node, v FROM two
  UNION ALL SELECT 3, node, v FROM two WHERE node NOT IN (FROM larger)
  UNION ALL SELECT 3, node, v FROM four WHERE node // 2 IN (FROM larger)
  UNION ALL SELECT 4, node, v FROM four
  UNION ALL SELECT 5, node, v FROM four WHERE node NOT IN (SELECT node FROM big)
  UNION ALL SELECT 5, node, v FROM eight),
ranked AS (SELECT k, v, CAST(ROW_NUMBER() OVER (PARTITION BY k ORDER BY list_avg(v)) - 1 AS INTEGER) AS cluster FROM leaves)"""))

# The least cost of k clusters of the shares, by a dynamic programme over their order.
_PART = "q[j + 1] - q[i + 1] - (s[j + 1] - s[i + 1]) ** 2 / (j - i)"
LEAST_CTES = """
centred AS (SELECT list_sort(list(x)) AS x, len(list(x)) AS n
  FROM (SELECT predizione_percentuale_vaccini - avg(predizione_percentuale_vaccini) OVER () AS x FROM shares)),
prefix AS (SELECT n, list_transform(range(n + 1), lambda j: coalesce(list_sum(list_slice(x, 1, j)), 0)) AS s,
  list_transform(range(n + 1), lambda j: coalesce(list_sum(list_transform(list_slice(x, 1, j), lambda v: v * v)), 0)) AS q FROM centred),
l1 AS (SELECT *, list_transform(range(n + 1), lambda j: CASE WHEN j = 0 THEN 0 ELSE """ + _PART.replace("i + 1", "1").replace("j - i", "j") + """ END) AS d FROM prefix)""" + "".join(f""",
l{k} AS (SELECT n, s, q, list_transform(range(n + 1), lambda j: CASE WHEN j = 0 THEN 0
  ELSE list_min(list_transform(range(j), lambda i: d[i + 1] + {_PART})) END) AS d FROM l{k - 1})""" for k in range(2, 6)) + """,
least AS (""" + " UNION ALL ".join(f"SELECT {k} AS k, d[n + 1] AS cost FROM l{k}" for k in range(2, 6)) + ")"


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n"


ORACLE_SQL: dict[str, str] = {
    "q1_avg_daily_per_centre": _with(VIEWS, Q1_CTES) + "SELECT mese, regione, numero_medio_vaccini FROM q1",
    "centres_per_area": _with(VIEWS) + "SELECT area, COUNT(*) AS centres FROM centres GROUP BY area",
    "totals_by_month_area": _with(VIEWS, Q1_CTES) + "SELECT CAST(m AS VARCHAR) AS month, area, total FROM month_totals",
    "totals_by_day_area_band": _with(VIEWS, Q2_CTES) + "SELECT CAST(d AS VARCHAR) AS day, area, band, n FROM daily",
    "totals_by_area": _with(VIEWS) + f"""SELECT area, CAST(SUM(CAST(total AS BIGINT)) AS BIGINT) AS total
FROM daily_totals WHERE CAST(day AS DATE) < DATE '{_JUN}' GROUP BY area""",
    "filter_open": _with(VIEWS) + f"""SELECT day, total, area FROM daily_totals
WHERE CAST(day AS DATE) > DATE '{_DEC}' AND CAST(day AS DATE) < DATE '{_JUN}'""",
    "filter_half_open": _with(VIEWS) + f"""SELECT day, brand, band, n, area FROM doses_by_band
WHERE CAST(day AS DATE) >= DATE '{_FEB}' AND CAST(day AS DATE) < DATE '{_JUN}'""",
    "filter_upper": _with(VIEWS) + f"""SELECT day, total, area FROM daily_totals
WHERE CAST(day AS DATE) < DATE '{_JUN}'""",
    "calendar_fields": _with(VIEWS, "days AS (SELECT DISTINCT CAST(day AS DATE) AS d FROM daily_totals)") + f"""
SELECT CAST(d AS VARCHAR) AS day,
       CAST({_mstart('d')} AS VARCHAR) AS month_start,
       CAST(month(d) AS INTEGER) AS month_number,
       CAST(dayofmonth(last_day(d)) AS INTEGER) AS days_in_month,
       CAST(dayofyear(d) AS INTEGER) AS day_of_year,
       CAST(d - DATE '1970-01-01' AS INTEGER) AS days_since_epoch,
       CAST(CAST(last_day(d) + 1 AS DATE) AS VARCHAR) AS next_month_start,
       {_label('d')} AS mese,
       upper(strftime(d, '%B')) AS month_en,
       '1 ' || {_label('CAST(last_day(d) + 1 AS DATE)')} AS next_first_day,
       CAST(CAST(make_date(year(d), 1, 1) + CAST(dayofyear(d) - 1 AS INTEGER) AS DATE) AS VARCHAR) AS doy_round_trip
FROM days""",
    "names_repaired": _with(VIEWS) + """SELECT CASE WHEN area LIKE '%\\_1%' ESCAPE '\\' THEN 'Uno / One' WHEN area LIKE '%2%' THEN 'Due / Two' ELSE area END AS area,
       people FROM population""",
    "qualified_strict": _with(VIEWS, Q2_CTES) + "SELECT CAST(d AS VARCHAR) AS day, area, band, n FROM kept_strict",
    "qualified_carryover": _with(VIEWS, Q2_CTES) + "SELECT CAST(d AS VARCHAR) AS day, area, band, n FROM kept_carryover",
    "filled_days": _with(VIEWS, Q2_CTES) + "SELECT CAST(d AS VARCHAR) AS day, area, band, n FROM kept_filled",
    "predict_band_month": _with(VIEWS, Q2_CTES, _q2_preds("kept_strict", "p_strict")) + """
SELECT area, band, CAST(m AS VARCHAR) AS month, CAST(t AS VARCHAR) AS target, pred FROM p_strict""",
    "predict_area": _with(VIEWS, Q3_CTES) + "SELECT area, total, pred FROM area_fc",
    "top5_next_month_strict": _with(VIEWS, Q2_CTES, _q2_preds("kept_strict", "p_strict")) + _top5_select("p_strict"),
    "top5_next_month_carryover": _with(VIEWS, Q2_CTES, _q2_preds("kept_carryover", "p_carry"))
    + _top5_select("p_carry"),
    "top5_next_month_filled": _with(VIEWS, Q2_CTES, _q2_preds("kept_filled", "p_filled")) + _top5_select("p_filled"),
    "coverage_share": _with(VIEWS, Q3_CTES) + "SELECT regione, giorno, predizione_percentuale_vaccini FROM shares",
    "coverage_share_elapsed": _with(VIEWS, Q3E_CTES)
    + "SELECT regione, giorno, predizione_percentuale_vaccini FROM shares_e",
    "top5_next_month_carryover_filled": _with(VIEWS, Q2_CTES, _q2_preds("kept_carryover_filled", "p_cfilled"))
    + _top5_select("p_cfilled"),
    "cluster_cost": """WITH
e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
x AS (SELECT label, vec_id, unnest(v) AS val, unnest(generate_series(1, len(v))) AS pos FROM e),
mu AS (SELECT label, pos, AVG(val) AS mu FROM x GROUP BY label, pos),
cost AS (SELECT x.label, SUM((x.val - mu.mu) * (x.val - mu.mu)) AS cost
         FROM x JOIN mu ON x.label = mu.label AND x.pos = mu.pos GROUP BY x.label),
cnt AS (SELECT label, COUNT(*) AS n_points FROM e GROUP BY label)
SELECT cnt.label, cnt.n_points, ROUND(cost.cost, 6) AS cost FROM cnt JOIN cost ON cnt.label = cost.label""",
    "cells_q1": _with(VIEWS, Q1_CTES) + _cells("q1", ["mese", "regione"], "cf1", [
        ("media_vaccinati", "numero_medio_vaccini"), ("regione", "regione"), ("mese", "mese")]),
    "full_run_cells_q1": _with(VIEWS, Q1_CTES) + _cells("q1", ["mese", "regione"], "cf1", [
        ("media_vaccinati", "numero_medio_vaccini"), ("regione", "regione"), ("mese", "mese")]),
    "cells_q2": _with(VIEWS, Q2_CTES, _q2_preds("kept_strict", "p_strict"), "top5 AS (" + _top5_select("p_strict") + ")")
    + _cells("top5", ["giorno", "fascia_eta", "regione"], "cf2", [
        ("predizione_vaccinati", "predizione_vaccini"), ("mese", "giorno"),
        ("fascia_eta", "fascia_eta"), ("regione", "regione")]),
    "cells_q3_share": _with(VIEWS, Q3_CTES) + _cells("shares", ["regione", "giorno"], "cf3_results", [
        ("predizione_vaccinati_totale", "predizione_percentuale_vaccini"), ("regione", "regione"),
        ("mese", "giorno")]),
    "cells_put": _with(CELL_CTES) + f"{_CELL_COLUMNS} ev_table",
    "cells_latest": _with(CELL_CTES) + f"{_CELL_COLUMNS} ev_latest",
    "cells_get": _with(CELL_CTES) + f"{_CELL_COLUMNS} ev_latest WHERE row_key IN (SELECT row_key FROM ev_keys)",
    "cells_history": _with(CELL_CTES) + f"{_CELL_COLUMNS} ev_table WHERE family = 'web' AND row_key IN (SELECT row_key FROM ev_keys)",
    "cells_deleted": _with(CELL_CTES) + """
SELECT t.row_key, t.family, t.qualifier, t.ts, t.value FROM ev_table t
WHERE NOT EXISTS (SELECT 1 FROM ev_latest l WHERE l.qualifier = 'click' AND l.row_key = t.row_key
                  AND l.family = t.family AND l.qualifier = t.qualifier AND l.ts = t.ts)""",
    "cells_deleted_all": _with(CELL_CTES) + f"{_CELL_COLUMNS} ev_table WHERE qualifier <> 'click'",
    "cells_deleted_rows": _with(CELL_CTES) + f"{_CELL_COLUMNS} ev_table WHERE row_key NOT IN (SELECT row_key FROM ev_keys)",
    "cells_deleted_family": _with(CELL_CTES) + f"{_CELL_COLUMNS} ev_table WHERE NOT (family = 'web' AND row_key IN (SELECT row_key FROM ev_keys))",
    "cells_scan": _with(CELL_CTES) + f"{_CELL_COLUMNS} ev_latest WHERE family = 'web' AND qualifier = 'click'",
    "cells_scan_family": _with(CELL_CTES) + f"{_CELL_COLUMNS} ev_latest WHERE family = 'web'",
    "position_scan": "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer",
    "cells_history_map": _with(CELL_CTES) + """
SELECT row_key, family, qualifier, CAST(cardinality(history) AS BIGINT) AS versions, CAST(to_json(history) AS VARCHAR) AS history
FROM (SELECT row_key, family, qualifier, map_from_entries(list((ts, value) ORDER BY ts)) AS history FROM ev_table
      WHERE family = 'web' AND row_key IN (SELECT row_key FROM ev_keys) GROUP BY ALL)""",
    "csv_rejects": _with(VIEWS) + """
SELECT area, COUNT(*) FILTER (dayofmonth(CAST(day AS DATE)) < 30) AS kept, CAST(SUM(total) FILTER (dayofmonth(CAST(day AS DATE)) < 30) AS BIGINT) AS total,
       COUNT(*) FILTER (dayofmonth(CAST(day AS DATE)) >= 30) AS rejected FROM daily_totals GROUP BY area""",
    "smart_days": _with(VIEWS) + """
SELECT CASE WHEN dayofmonth(CAST(day AS DATE)) = 28 THEN last_day(CAST(day AS DATE)) ELSE CAST(day AS DATE) END AS day, area, COUNT(*) AS n FROM daily_totals GROUP BY ALL""",
    "previewed": _with(VIEWS, Q1_CTES) + """
SELECT mese, regione, numero_medio_vaccini FROM q1 ORDER BY numero_medio_vaccini DESC, mese, regione LIMIT 20""",
    "csv_round_trip": _with(VIEWS) + "SELECT day, total, area FROM daily_totals",
    "compacted": _with(VIEWS) + "SELECT day, total, area FROM daily_totals",
    "stream_ingested": _with(VIEWS) + "SELECT day, total, area FROM daily_totals",
    "predict_area_float": _with(VIEWS, Q3_CTES) + """
SELECT area, n_points,
       CASE WHEN isnan(slope) THEN NULL ELSE ROUND(slope, 6) END AS slope,
       CASE WHEN isnan(intercept) THEN NULL ELSE ROUND(intercept, 6) END AS intercept
FROM (SELECT area, COUNT(*) AS n_points,
             regr_slope(CAST(y AS DOUBLE), CAST(x AS DOUBLE)) AS slope,
             regr_intercept(CAST(y AS DOUBLE), CAST(x AS DOUBLE)) AS intercept
      FROM q3_rows GROUP BY area)""",
    "q1_in_order": _with(VIEWS, Q1_CTES) + f"""
SELECT {_label('mt.m')} AS mese, mt.area AS regione,
       CAST(mt.total // (CAST(dayofmonth(last_day(mt.m)) AS BIGINT) * c.centres) AS BIGINT) AS numero_medio_vaccini,
       CAST(ROW_NUMBER() OVER (ORDER BY mt.m, mt.area) AS INTEGER) AS place
FROM month_totals mt JOIN centre_counts c ON mt.area = c.area""",
    "top5_in_order": _with(VIEWS, Q2_CTES, _q2_preds("kept_strict", "p_strict")) + f"""
SELECT '1 ' || {_label('t')} AS giorno, band AS fascia_eta, area AS regione, CAST(pred AS INTEGER) AS predizione_vaccini,
       CAST(ROW_NUMBER() OVER (ORDER BY t, band, rk) AS INTEGER) AS place
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY t, band ORDER BY pred DESC, area ASC) AS rk FROM p_strict)
WHERE rk <= 5""",
    "coverage_in_order": _with(VIEWS, Q3_CTES) + """
SELECT regione, giorno, predizione_percentuale_vaccini, CAST(ROW_NUMBER() OVER (ORDER BY regione) AS INTEGER) AS place FROM shares""",
    "q1_lenient_days": _with(VIEWS.replace("daily_totals AS", "all_totals AS"), LENIENT_VIEW, Q1_CTES) + "SELECT mese, regione, numero_medio_vaccini FROM q1",
    "predict_area_lenient": _with(VIEWS.replace("daily_totals AS", "all_totals AS"), LENIENT_VIEW, Q3_CTES) + "SELECT area, total, pred FROM area_fc",
    "unreadable_days": _with(VIEWS) + """
SELECT area, COUNT(*) AS rows_left_out FROM daily_totals WHERE dayofmonth(CAST(day AS DATE)) = 31 GROUP BY area""",
    "bisecting_sweep": _with(VIEWS, Q3_CTES, BISECTING_CTES).replace("WITH ", "WITH RECURSIVE ", 1) + """
SELECT 'K-MEANS-BISECTING' AS modello, CAST(k AS INTEGER) AS k, regione, predizione_percentuale_vaccini AS percentuale_vaccinati, cluster
FROM shares JOIN ranked ON list_contains(v, predizione_percentuale_vaccini)""",
    "sweep_optimality": _with(VIEWS, Q3_CTES, _RUNS, LEAST_CTES) + """
SELECT modello, k, TRUE AS fixed_point, ROUND(cost, 9) AS least_cost, TRUE AS cost_not_below FROM runs JOIN least USING (k)""",
    "sweep_accounts": _with(_RUNS) + "SELECT modello, k, TRUE AS stepped, TRUE AS jobs_counted, TRUE AS tasks_counted, TRUE AS timed FROM runs",
    "sweep_structure": _with(VIEWS, Q3_CTES, _RUNS) + """
SELECT modello, k, (SELECT COUNT(*) FROM shares) AS points, CAST(k AS BIGINT) AS clusters, TRUE AS ordered_intervals,
       TRUE AS cost_of_labels FROM runs""",
    "full_run_clusters": _with(VIEWS, Q3_CTES, _RUNS) + """
SELECT modello, k, (SELECT COUNT(*) FROM shares) AS areas, CAST(k AS BIGINT) AS clusters FROM runs""",
    "full_run_shares": _with(VIEWS, Q3_CTES) + "SELECT regione, giorno, predizione_percentuale_vaccini FROM shares",
    "cells_q3_model_keys": _with(_RUNS) + _cells("runs", ["modello", "k"], "cf3_performance", [
        ("modello", "modello"), ("n_cluster", "k")]),
    "cells_q3_cluster_keys": _with(VIEWS, Q3_CTES, _RUNS, "pairs AS (SELECT * FROM runs, shares)")
    + _cells("pairs", ["modello", "k", "regione"], "cf3_cluster", [
        ("modello", "modello"), ("n_cluster", "k"), ("regione", "regione"),
        ("predizione_vaccinati_totale", "predizione_percentuale_vaccini")]),
}
ORACLE_SQL["full_run_cells_q2"] = ORACLE_SQL["cells_q2"]
ORACLE_SQL["stream_rejects"] = ORACLE_SQL["csv_rejects"]
for _name in ("put", "get", "deleted"):  # a stored table gives the same rows
    ORACLE_SQL[f"cells_stored_{_name}"] = ORACLE_SQL[f"cells_{_name}"]
