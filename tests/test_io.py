"""Sources and sinks: positional scans, results, CSV, compaction, streaming ingest, full run."""

import os

import pytest

from regioncast.plans.params import STAND_IN
from regioncast.plans.run import run_all
from regioncast.sinks import compact, preview, write_cells, write_csv, write_result
from regioncast.sources import REFERENCE_FILES, by_position, ingest_csv, read_inputs, read_result, tables
from regioncast.streaming import ingest_csv_stream
from tests.conftest import SF_SMALL


def _text_days(df):
    return df.withColumn("day", df.day.cast("string"))


def test_by_position(spark):
    df = spark.createDataFrame([(1, "x", 2.0, "A")], "a int, b string, c double, d string")
    assert by_position(df, [0, 2, -1]).columns == ["a", "c", "d"]
    assert by_position(df, {0: "day", -1: "area"}).columns == ["day", "area"]
    with pytest.raises(IndexError):
        by_position(df, [4])


def test_result_round_trip_append_and_compact(spark, tmp_out):
    df = spark.createDataFrame([(i, f"r{i}") for i in range(10)], "i int, s string")
    write_result(df.where("i < 5"), tmp_out, "staging", mode="append")
    write_result(df.where("i >= 5").repartition(3), tmp_out, "staging", mode="append")
    assert read_result(spark, "staging", tmp_out).count() == 10
    out = compact(spark, f"{tmp_out}/staging", f"{tmp_out}/one", num_files=1)
    assert sorted(r.i for r in out.collect()) == list(range(10))
    parts = [f for f in os.listdir(f"{tmp_out}/one") if f.endswith(".parquet")]
    assert len(parts) == 1
    with pytest.raises(ValueError):
        compact(spark, f"{tmp_out}/one", f"{tmp_out}/one")


def test_csv_round_trip(spark, tmp_out):
    daily = _text_days(tables.daily_totals(spark, SF_SMALL))
    path = write_csv(daily, tmp_out, "daily")
    back = ingest_csv(spark, path, "day STRING, total BIGINT, area STRING", dst=f"{tmp_out}/parquet")
    assert sorted(back.collect()) == sorted(daily.collect())


def test_stream_ingest_once(spark, tmp_out):
    daily = _text_days(tables.daily_totals(spark, SF_SMALL))
    src = write_csv(daily, tmp_out, "incoming")
    q = ingest_csv_stream(spark, src, "day STRING, total BIGINT, area STRING", f"{tmp_out}/in_parquet",
                          f"{tmp_out}/ckpt")
    q.awaitTermination(120)
    assert sorted(spark.read.parquet(f"{tmp_out}/in_parquet").collect()) == sorted(daily.collect())
    # A second run over the same folder finds nothing new.
    q = ingest_csv_stream(spark, src, "day STRING, total BIGINT, area STRING", f"{tmp_out}/in_parquet",
                          f"{tmp_out}/ckpt")
    q.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_out}/in_parquet").count() == daily.count()


def test_run_all_writes_results_and_cells(spark, tmp_out):
    inputs = {
        "daily_totals": tables.daily_totals(spark, SF_SMALL),
        "centres": tables.centres(spark, SF_SMALL),
        "doses_by_band": tables.doses_by_band(spark, SF_SMALL),
        "population": tables.population(spark, SF_SMALL),
    }
    paths = run_all(spark, inputs, tmp_out, bounds=STAND_IN, ts=7, debug_csv=True)
    q1 = spark.read.parquet(paths["q1"])
    assert q1.columns == ["mese", "regione", "numero_medio_vaccini"] and q1.count() > 0
    assert spark.read.parquet(paths["q3_cluster"]).count() == 8 * spark.read.parquet(paths["q3_share"]).count()
    cells = spark.read.parquet(paths["cells_q1"])
    assert cells.count() == 3 * q1.count()
    assert {r.ts for r in cells.select("ts").distinct().collect()} == {7}
    csv_q1 = spark.read.option("header", True).csv(f"{tmp_out}/csv/query1_results")
    assert csv_q1.count() == q1.count()
    only = run_all(spark, inputs, f"{tmp_out}/only", bounds=STAND_IN, ts=7, queries=("q2",))
    assert set(only) == {"q2", "cells_q2"}


def test_full_run_from_positional_files(spark, tmp_out):
    """Inputs laid out by position as the reference reads them, under its file names."""
    from pyspark.sql import functions as F

    src = f"{tmp_out}/input"
    daily = tables.daily_totals(spark, SF_SMALL)
    daily.select("day", F.lit("x").alias("filler"), F.col("total").cast("int").alias("total"), "area") \
        .write.parquet(f"{src}/{REFERENCE_FILES['daily_totals']}")
    tables.centres(spark, SF_SMALL).select(F.col("centre").cast("string"), "area") \
        .write.parquet(f"{src}/{REFERENCE_FILES['centres']}")
    tables.doses_by_band(spark, SF_SMALL).select("day", "brand", F.lit("f").alias("filler"), "band",
                                                  F.lit(0).alias("men"), "n", "area") \
        .write.parquet(f"{src}/{REFERENCE_FILES['doses_by_band']}")
    tables.population(spark, SF_SMALL).select("area", F.col("people").cast("int")) \
        .write.parquet(f"{src}/{REFERENCE_FILES['population']}")
    inputs = read_inputs(spark, src)
    assert inputs["doses_by_band"].columns == ["day", "band", "n", "area"]
    paths = run_all(spark, inputs, f"{tmp_out}/out", bounds=STAND_IN, ts=3)
    direct = run_all(spark, {
        "daily_totals": tables.daily_totals(spark, SF_SMALL),
        "centres": tables.centres(spark, SF_SMALL),
        "doses_by_band": tables.doses_by_band(spark, SF_SMALL),
        "population": tables.population(spark, SF_SMALL),
    }, f"{tmp_out}/direct", bounds=STAND_IN, ts=3, export=False)
    for key in ("q1", "q2", "q3_share"):
        assert sorted(spark.read.parquet(paths[key]).collect()) == sorted(spark.read.parquet(direct[key]).collect())


def test_compact_by_rows_per_file_and_preview(spark, tmp_out, capsys):
    df = spark.createDataFrame([(i,) for i in range(100)], "i int").repartition(7)
    write_result(df, tmp_out, "many")
    out = compact(spark, f"{tmp_out}/many", f"{tmp_out}/few", rows_per_file=40)
    parts = [f for f in os.listdir(f"{tmp_out}/few") if f.endswith(".parquet")]
    assert len(parts) == 3 and out.count() == 100
    preview(out, 5)
    assert "only showing top 5 rows" in capsys.readouterr().out


def test_write_cells_overwrite_recreates(spark, tmp_out):
    from regioncast.operators.cells import CELL_SCHEMA

    first = spark.createDataFrame([("r", "cf", "q", 1, "a")], CELL_SCHEMA)
    second = spark.createDataFrame([("s", "cf", "q", 2, "b")], CELL_SCHEMA)
    path = write_cells(first, tmp_out, "Query1_table")
    write_cells(second, tmp_out, "Query1_table")
    assert [r.row_key for r in spark.read.parquet(path).collect()] == ["s"]


def test_partitioned_ingest_and_stream_picks_up_new_files(spark, tmp_out):
    from pyspark.sql import functions as F

    daily = _text_days(tables.daily_totals(spark, SF_SMALL)).withColumn("year", F.substring("day", 1, 4))
    schema = "day STRING, total BIGINT, area STRING, year STRING"
    first = write_csv(daily.where("year < '1999'"), tmp_out, "batch1")
    back = ingest_csv(spark, first, schema, dst=f"{tmp_out}/by_year", partition_by=["year"])
    assert any(name.startswith("year=") for name in os.listdir(f"{tmp_out}/by_year"))
    assert back.count() == daily.where("year < '1999'").count()

    incoming = f"{tmp_out}/incoming"
    os.makedirs(incoming)
    for name in os.listdir(first):
        if name.endswith(".csv"):
            os.link(f"{first}/{name}", f"{incoming}/{name}")
    q = ingest_csv_stream(spark, incoming, schema, f"{tmp_out}/stream_out", f"{tmp_out}/stream_ckpt",
                          partition_by=["year"], max_files_per_trigger=1)
    q.awaitTermination(120)
    later = write_csv(daily.where("year >= '1999'"), tmp_out, "batch2")
    for name in os.listdir(later):
        if name.endswith(".csv"):
            os.link(f"{later}/{name}", f"{incoming}/late-{name}")
    q = ingest_csv_stream(spark, incoming, schema, f"{tmp_out}/stream_out", f"{tmp_out}/stream_ckpt",
                          partition_by=["year"], max_files_per_trigger=1)
    q.awaitTermination(120)
    out = spark.read.parquet(f"{tmp_out}/stream_out")
    assert sorted(out.select("day", "total", "area").collect()) == sorted(daily.select("day", "total", "area").collect())


def test_command_line_full_run(spark, tmp_out):
    import subprocess
    import sys

    from pyspark.sql import functions as F

    src = f"{tmp_out}/input"
    tables.daily_totals(spark, SF_SMALL).select("day", F.lit("x").alias("f"), "total", "area") \
        .write.parquet(f"{src}/{REFERENCE_FILES['daily_totals']}")
    tables.centres(spark, SF_SMALL).select(F.col("centre").cast("string"), "area") \
        .write.parquet(f"{src}/{REFERENCE_FILES['centres']}")
    tables.doses_by_band(spark, SF_SMALL).select("day", "brand", F.lit("f").alias("f"), "band",
                                                  F.lit(0).alias("m"), "n", "area") \
        .write.parquet(f"{src}/{REFERENCE_FILES['doses_by_band']}")
    tables.population(spark, SF_SMALL).write.parquet(f"{src}/{REFERENCE_FILES['population']}")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    cmd = [sys.executable, "-m", "regioncast.plans.run", src, f"{tmp_out}/out", "--only", "q1", "--debug",
           "--last-december", STAND_IN["last_december"], "--first-february", STAND_IN["first_february"],
           "--first-june", STAND_IN["first_june"]]
    done = subprocess.run(cmd, cwd=repo, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "q1\t" in done.stdout
    q1 = spark.read.parquet(f"{tmp_out}/out/query1_results")
    from regioncast.plans import avg_daily_doses_per_centre

    avg_q1 = avg_daily_doses_per_centre(tables.daily_totals(spark, SF_SMALL), tables.centres(spark, SF_SMALL),
                                        STAND_IN["last_december"], STAND_IN["first_june"])
    want = sorted(avg_q1.collect())
    assert sorted(q1.collect()) == want
    assert os.path.isdir(f"{tmp_out}/out/csv/query1_results")
    assert not os.path.exists(f"{tmp_out}/out/cells")
