"""Stored cell tables, history maps, compaction by bytes, ingest past malformed records, previews."""

import datetime as dt
import os
import re
import uuid

import pytest
from pyspark.sql import functions as F

from regioncast.functions.calendar import parse_day
from regioncast.operators.accounting import group_counts, job_group
from regioncast.operators.cells import CELL_SCHEMA, delete_cells, history_map, latest_cells, open_cells, put_cells, store_cells
from regioncast.sinks.files import compact, listed_bytes, preview
from regioncast.sources.files import ingest_csv
from regioncast.streaming.ingest import ingest_csv_stream


@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    kept = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, kept)


def cells(spark, n, ts=0):
    rows = spark.range(n).select(F.concat(F.lit("r"), F.col("id") % 97).alias("row_key"), F.lit("cf").alias("family"),
                                 F.concat(F.lit("q"), F.col("id") % 11).alias("qualifier"), (F.col("id") + ts).alias("ts"),
                                 F.col("id").cast("string").alias("value"))
    return rows


def shuffled_scans(df):
    """Exchanges that have the scan of a bucketed table under them, and whether there is such a scan at all."""
    df.collect()
    lines = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].split("\n")
    depth = [len(re.match(r"[\s:+-]*", x).group()) for x in lines]
    found = 0
    for i, line in enumerate(lines):
        if re.match(r"[\s:+-]*(\*\(\d+\) )?(Shuffle|Exchange)", line):
            for j in range(i + 1, len(lines)):
                if depth[j] <= depth[i]:
                    break
                found += "Bucketed: true" in lines[j] or "SelectedBucketsCount" in lines[j]
    scans = sum("SelectedBucketsCount" in x or "Bucketed: true" in x for x in lines)
    return found, scans


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_stored_table_is_not_shuffled(spark, tmp_out, no_broadcast):
    plain, batch = cells(spark, 4000), cells(spark, 500, ts=3800)
    name = f"t{uuid.uuid4().hex}"
    table = store_cells(plain, name, f"{tmp_out}/{name}", buckets=4)
    keys = spark.createDataFrame([("r1",), ("r5",)], "row_key string")
    columns = spark.createDataFrame([("r1", "cf", "q1"), ("r2", "cf", "q2")], "row_key string, family string, qualifier string")
    for make in (lambda t: put_cells(t, batch), lambda t: latest_cells(t), lambda t: latest_cells(t, keys), lambda t: latest_cells(t, columns),
                 lambda t: delete_cells(t, keys), lambda t: delete_cells(t, columns, versions="all"), lambda t: delete_cells(t, columns)):
        got = make(table)
        shuffled, scans = shuffled_scans(got)
        assert scans >= 1 and shuffled == 0
        assert rows_of(got) == rows_of(make(plain))


def test_stored_table_opens_in_another_catalog(spark, tmp_out):
    name = f"t{uuid.uuid4().hex}"
    table = store_cells(cells(spark, 300), name, f"{tmp_out}/{name}", buckets=3)
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    again = open_cells(spark, name, f"{tmp_out}/{name}", buckets=3)
    assert rows_of(again) == rows_of(cells(spark, 300)) and again.columns == table.columns


def test_history_map_and_its_limit(spark):
    rows = [("r", "cf", "q", 2, "b"), ("r", "cf", "q", 1, "a"), ("r", "cf", "q", 1, "A"), ("s", "cf", "q", 5, None)]
    df = spark.createDataFrame(rows, CELL_SCHEMA)
    got = {r.row_key: r.history for r in history_map(df).collect()}
    assert got == {"r": {1: "a", 2: "b"}, "s": {5: None}}
    assert list(got["r"]) == [1, 2]
    only = history_map(df, spark.createDataFrame([("s",)], "row_key string")).collect()
    assert [r.row_key for r in only] == ["s"]
    with pytest.raises(Exception, match="too many versions for a map in cell r/cf/q"):
        history_map(df, max_versions=1).collect()
    assert history_map(spark.createDataFrame([], CELL_SCHEMA)).collect() == []


@pytest.mark.parametrize("width", [8, 4000])
def test_compaction_by_bytes(spark, tmp_out, width):
    rows = 200_000 if width == 8 else 1500
    text = F.substring(F.concat(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(i))), 256) for i in range(-(-width // 64))]), 1, width)
    spark.range(rows).repartition(30).select("id", text.alias("t")).write.parquet(f"{tmp_out}/many")
    listed = listed_bytes(spark, f"{tmp_out}/many")
    assert listed == sum(os.path.getsize(f"{tmp_out}/many/{f}") for f in os.listdir(f"{tmp_out}/many") if f.endswith(".parquet"))
    target = listed // 5
    with job_group(spark, f"compact-{width}"):
        out = compact(spark, f"{tmp_out}/many", f"{tmp_out}/few", file_bytes=target)
    sizes = [os.path.getsize(f"{tmp_out}/few/{f}") for f in os.listdir(f"{tmp_out}/few") if f.endswith(".parquet")]
    assert all(target / 2 <= s <= 2 * target for s in sizes) and 4 <= len(sizes) <= 6
    assert out.count() == rows
    # listing the files, reading schemas and writing; a count of the rows would be one more pass over 30 files
    assert group_counts(spark, f"compact-{width}")[0] <= 6
    assert listed_bytes(spark, f"{tmp_out}/many", "*.none") == 0


RECORDS = ["day,total,area", "2021-01-01,5,A", "2021-01-02,x,A", "2021-01-03,7,A,more", "2021-01-04,8", ",9,B", "not a record", "2021-01-05,10,B"]
SCHEMA = "day DATE, total BIGINT, area STRING"


def write_records(folder, name="a.csv"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(RECORDS) + "\n")


def test_ingest_goes_on_past_malformed_records(spark, tmp_out):
    write_records(f"{tmp_out}/in")
    with pytest.raises(Exception, match="(?i)malformed"):
        ingest_csv(spark, f"{tmp_out}/in", SCHEMA, f"{tmp_out}/fast").count()
    with pytest.raises(ValueError, match="destination"):
        ingest_csv(spark, f"{tmp_out}/in", SCHEMA, rejects=f"{tmp_out}/bad")
    good = ingest_csv(spark, f"{tmp_out}/in", SCHEMA, f"{tmp_out}/good", rejects=f"{tmp_out}/bad")
    assert good.columns == ["day", "total", "area"]
    assert sorted(r.total for r in good.collect()) == [5, 9, 10]
    bad = spark.read.parquet(f"{tmp_out}/bad").collect()
    assert sorted(r.record for r in bad) == sorted(RECORDS[i] for i in (2, 3, 4, 6))
    assert all(r.file.endswith("a.csv") for r in bad)
    assert next(r.parsed for r in bad if r.record == RECORDS[2]) == '{"day":"2021-01-02","area":"A"}'


def test_stream_goes_on_past_malformed_records_once_each(spark, tmp_out):
    def run():
        ingest_csv_stream(spark, f"{tmp_out}/in", SCHEMA, f"{tmp_out}/good", f"{tmp_out}/done", max_files_per_trigger=1,
                          rejects=f"{tmp_out}/bad").awaitTermination()

    write_records(f"{tmp_out}/in", "a.csv")
    write_records(f"{tmp_out}/in", "b.csv")
    run()
    write_records(f"{tmp_out}/in", "late.csv")
    run()
    assert spark.read.parquet(f"{tmp_out}/good").count() == 9 and spark.read.parquet(f"{tmp_out}/bad").count() == 12
    # a batch that was written but not recorded is written over when it runs again
    last = max(int(x) for x in os.listdir(f"{tmp_out}/done/commits") if x.isdigit())
    os.rename(f"{tmp_out}/done/commits/{last}", f"{tmp_out}/recorded")
    crc = f"{tmp_out}/done/commits/.{last}.crc"
    if os.path.exists(crc):
        os.rename(crc, f"{tmp_out}/recorded.crc")
    run()
    assert spark.read.parquet(f"{tmp_out}/good").count() == 9 and spark.read.parquet(f"{tmp_out}/bad").count() == 12


def test_preview_returns_its_rows(spark, capsys):
    rows = preview(spark.range(50).orderBy(F.desc("id")), 3)
    assert [r.id for r in rows.collect()] == [49, 48, 47]
    assert "only showing top 3 rows" in capsys.readouterr().out


def test_smart_days(spark):
    rows = [("2021-02-30",), ("2020-02-31",), ("2021-04-31",), ("2021-01-31",), ("2021-13-01",), ("2021-01-32",), ("x",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(parse_day("t", mode="smart")).collect()]
    assert got == [dt.date(2021, 2, 28), dt.date(2020, 2, 29), dt.date(2021, 4, 30), dt.date(2021, 1, 31), None, None, None, None]
