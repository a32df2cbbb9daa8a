"""Versioned key-value cell tables as DataFrames.

A cell table has the columns ``(row_key, family, qualifier, ts, value)``;
``ts`` is the version (BIGINT) and every version is kept, as in the
reference's store (unlimited versions).  The reference talks to its store
one cell at a time from the driver; here each operation is one DataFrame
transformation over whole tables, so puts, gets, deletes and scans run as
distributed aggregates and joins.

Skew: a single hot cell may hold a large share of all versions.  Latest
values are max-aggregates (partial aggregation before the shuffle), and the
history is returned one row per version (never collected into one list).
Puts, key lookups and deletes are plain joins with the batch or key list:
Spark broadcasts a side only below its byte threshold, and AQE splits a
skewed key of a shuffle join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

CELL_COLUMNS = ("row_key", "family", "qualifier", "ts", "value")
CELL_SCHEMA = StructType([
    StructField("row_key", StringType(), False),
    StructField("family", StringType(), False),
    StructField("qualifier", StringType(), False),
    StructField("ts", LongType(), False),
    StructField("value", StringType(), True),
])
CELL_ID = ("row_key", "family", "qualifier")

# Fixed value: separator between the parts of a row key.
KEY_SEP = "/"


def check_cells(df: DataFrame, what: str = "cells", keep: Sequence[str] = ()) -> DataFrame:
    """Schema check of a cell table (replaces the reference's triple count check); ``keep`` names further columns."""
    missing = [c for c in CELL_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing cell column(s) {', '.join(missing)}")
    return df.select(
        F.col("row_key").cast("string"), F.col("family").cast("string"),
        F.col("qualifier").cast("string"), F.col("ts").cast("bigint"), F.col("value").cast("string"), *keep)


def empty_cells(spark) -> DataFrame:
    return spark.createDataFrame([], CELL_SCHEMA)


def to_cells(df: DataFrame, key_cols: Sequence[str], family: str,
             qualifiers: Mapping[str, str | Column], ts: int) -> DataFrame:
    """Wide result -> cells.

    Row key: the key columns as text joined with ``/``; one cell per
    ``qualifier -> column``, the value as text (Spark prints doubles the
    way Java does, e.g. ``7.134186056607093E-4``).  The key parts stay
    readable as their own cells, so keys are never parsed back (B13).  A NULL
    key part fails the query: without it two keys could become one.
    """
    parts = [F.when(F.col(c).isNull(), F.raise_error(F.lit(f"NULL in key column '{c}'")).cast("string")).otherwise(F.col(c).cast("string"))
             for c in key_cols]
    key = F.concat_ws(KEY_SEP, *parts)
    wide = df.select(key.alias("row_key"), *[
        (F.col(src) if isinstance(src, str) else src).cast("string").alias(q)
        for q, src in qualifiers.items()])
    long = wide.unpivot(["row_key"], list(qualifiers), "qualifier", "value")
    return long.select("row_key", F.lit(family).alias("family"), "qualifier",
                       F.lit(int(ts)).cast("bigint").alias("ts"), "value")


def resolve_versions(cells: DataFrame, order: str | None = None) -> DataFrame:
    """One row per (row_key, family, qualifier, ts): of several writes of a
    version the last one stays.

    ``order`` names a column that numbers the writes; without it the
    greatest value stands for the last write.
    """
    picked = check_cells(cells)
    if order is None:
        value = F.max("value")
    else:
        picked = check_cells(cells, keep=(order,))
        value = F.max_by("value", order)
    return picked.groupBy(*CELL_ID, "ts").agg(value.alias("value")).select(*CELL_COLUMNS)


def put_cells(cells: DataFrame, new: DataFrame, order: str | None = None) -> DataFrame:
    """Put new cells (C2): new versions are added; a put on an existing
    (row_key, family, qualifier, ts) replaces that version.

    ``cells`` is a stored table (one row per version, as every put leaves
    it).  Writes of one version inside the batch resolve to the last one by
    ``order``; the old versions that the batch replaces are dropped with an
    anti-join on the version keys, and the resolved batch is appended.
    """
    old = check_cells(cells, "cells")
    batch = resolve_versions(new, order)
    kept = old.join(batch.select(*CELL_ID, "ts"), on=[*CELL_ID, "ts"], how="left_anti")
    return kept.unionByName(batch)


def _restrict(cells: DataFrame, keys: DataFrame | None) -> DataFrame:
    if keys is None:
        return cells
    on = [c for c in CELL_ID if c in keys.columns]
    if not on:
        raise ValueError("keys must have row_key and optionally family, qualifier")
    return cells.join(keys.select(*on), on=on, how="left_semi")


def latest_cells(cells: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Newest version of every cell, optionally only for ``keys``.

    Output: row_key, family, qualifier, ts, value.  Equal versions resolve
    to the greatest value.
    """
    newest = F.max(F.struct("ts", "value")).alias("_v")
    return (_restrict(cells, keys).groupBy(*CELL_ID).agg(newest)
            .select(*CELL_ID, F.col("_v.ts").alias("ts"), F.col("_v.value").alias("value")))


def cell_history(cells: DataFrame, keys: DataFrame | None = None, ordered: bool = False) -> DataFrame:
    """All versions of the selected cells, one row per version (C4).

    A version list can be arbitrarily long, so it stays in rows; ``ordered`` sorts the whole
    result by cell, then ts.  ``history_map`` is the reference's form of it.
    """
    hist = _restrict(cells, keys).select(*CELL_COLUMNS)
    return hist.orderBy(*CELL_ID, "ts") if ordered else hist


def history_map(cells: DataFrame, keys: DataFrame | None = None, max_versions: int = 1_000_000) -> DataFrame:
    """Per selected cell the map ``ts -> value`` of all its versions, in ascending order of ts (C4, the reference's form).

    Output: row_key, family, qualifier, history.  A cell's map is one value in one row, so it has to fit a task's memory: a cell of more than
    ``max_versions`` fails the query by name, rather than being cut; ``cell_history`` has no such limit.  Of equal versions the
    greatest value stays.
    """
    versions = resolve_versions(_restrict(cells, keys))
    many = F.raise_error(F.concat(F.lit("too many versions for a map in cell "), F.concat_ws(KEY_SEP, *CELL_ID))).cast("map<bigint,string>")
    listed = F.sort_array(F.collect_list(F.struct("ts", "value")))
    return versions.groupBy(*CELL_ID).agg(F.when(F.count("*") > max_versions, many).otherwise(F.map_from_entries(listed)).alias("history"))


def store_cells(cells: DataFrame, name: str, path: str, buckets: int = 64, by: Sequence[str] = ("row_key",)) -> DataFrame:
    """Write a cell table once, in ``buckets`` by a hash of ``by`` and sorted by cell and version, as the table ``name`` at ``path``.

    Puts, gets, deletes and scans of the stored table then shuffle the batch or key list only, never the table; for the
    joins this needs ``spark.sql.requireAllClusterKeysForCoPartition`` off, as `session.get_session` sets it.  A row that
    holds a large share of all cells is one bucket: bucket by all of `CELL_ID` then, and name whole cells in key lists.
    """
    writer = check_cells(cells).repartition(buckets, *by).write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, *by).sortBy(*CELL_ID, "ts").saveAsTable(name)
    return cells.sparkSession.table(name)


def open_cells(spark, name: str, path: str, buckets: int = 64, by: Sequence[str] = ("row_key",)) -> DataFrame:
    """A table of `store_cells` in a session whose catalog doesn't know it yet; ``buckets`` and ``by`` as it was stored with."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CELL_SCHEMA.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({', '.join(by)}) "
              f"SORTED BY ({', '.join((*CELL_ID, 'ts'))}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def delete_cells(cells: DataFrame, targets: DataFrame, versions: str = "latest") -> DataFrame:
    """Delete rows, families or columns named by ``targets``.

    ``targets`` has ``row_key`` and optionally ``family`` and ``qualifier``.
    Row and family deletes remove every version.  A column delete removes
    only the newest version when ``versions="latest"`` (what the reference's
    client call does) or all of them with ``versions="all"``.
    """
    if versions not in ("latest", "all"):
        raise ValueError("versions must be 'latest' or 'all'")
    on = [c for c in CELL_ID if c in targets.columns]
    if on[:1] != ["row_key"] or on != list(CELL_ID[:len(on)]):
        raise ValueError("targets need row_key, then optionally family, then qualifier")
    wanted = targets.select(*on)
    if versions == "all" or len(on) < 3:
        return cells.join(wanted, on=on, how="left_anti")
    newest = cells.join(wanted, on=on, how="left_semi").groupBy(*CELL_ID).agg(F.max("ts").alias("ts"))
    return cells.join(newest, on=[*CELL_ID, "ts"], how="left_anti")


def scan_cells(cells: DataFrame, family: str | None = None, qualifier: str | None = None) -> DataFrame:
    """Newest values of a table, narrowed to a family or a column."""
    cond = F.lit(True)
    if family is not None:
        cond = cond & (F.col("family") == family)
    if qualifier is not None:
        cond = cond & (F.col("qualifier") == qualifier)
    return latest_cells(cells.where(cond))
