"""Scans of input files and saved results.

The reference reads its four input files by column position (first column,
third column, last column ...).  ``by_position`` maps those ordinals to names
once, right at the scan, so everything downstream is by name and Catalyst can
prune the unused columns from the Parquet read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def by_position(df: DataFrame, positions: Sequence[int] | Mapping[int, str]) -> DataFrame:
    """Select columns by ordinal (negative = from the end), optionally renamed.

    ``positions`` is either a list of ordinals (names kept) or a mapping
    ``ordinal -> new name``.
    """
    cols = df.columns
    items = positions.items() if isinstance(positions, Mapping) else [(p, None) for p in positions]
    out = []
    for pos, name in items:
        if not -len(cols) <= pos < len(cols):
            raise IndexError(f"column position {pos} out of range for {len(cols)} columns")
        src = cols[pos]
        out.append(F.col(f"`{src}`").alias(name) if name else F.col(f"`{src}`"))
    return df.select(*out)


def read_daily_totals(spark: SparkSession, path: str) -> DataFrame:
    """Daily totals per area; position 0 day, 2 total, last area."""
    raw = spark.read.parquet(path)
    return by_position(raw, {0: "day", 2: "total", -1: "area"})


def read_centres(spark: SparkSession, path: str) -> DataFrame:
    """One row per vaccination centre; last column is the area."""
    raw = spark.read.parquet(path)
    return by_position(raw, {-1: "area"})


def read_doses_by_band(spark: SparkSession, path: str) -> DataFrame:
    """S3: doses by day, supplier, area and age band; 0 day, 3 band, 5 n, last area."""
    raw = spark.read.parquet(path)
    return by_position(raw, {0: "day", 3: "band", 5: "n", -1: "area"})


def read_population(spark: SparkSession, path: str) -> DataFrame:
    """Population per area; 0 area, 1 people."""
    raw = spark.read.parquet(path)
    return by_position(raw, {0: "area", 1: "people"})


# The reference's input file names, by role.
REFERENCE_FILES = {
    "daily_totals": "somministrazioni-vaccini-summary-latest.parquet",
    "centres": "punti-somministrazione-tipologia.parquet",
    "doses_by_band": "somministrazioni-vaccini-latest.parquet",
    "population": "totale-popolazione.parquet",
}


def read_inputs(spark: SparkSession, folder: str, files: Mapping[str, str] = REFERENCE_FILES) -> dict[str, DataFrame]:
    """The four inputs of a full run, read by position from ``folder``."""
    folder = folder.rstrip("/")
    return {
        "daily_totals": read_daily_totals(spark, f"{folder}/{files['daily_totals']}"),
        "centres": read_centres(spark, f"{folder}/{files['centres']}"),
        "doses_by_band": read_doses_by_band(spark, f"{folder}/{files['doses_by_band']}"),
        "population": read_population(spark, f"{folder}/{files['population']}"),
    }


def read_result(spark: SparkSession, name: str, folder: str) -> DataFrame:
    """Read a saved result folder ``folder/name`` (all part files)."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}")


#: Column that holds the text of a record that doesn't fit the schema.
BAD_RECORD = "_bad_record"


def permissive(schema: StructType | str) -> StructType:
    """The schema with `BAD_RECORD` after its columns."""
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    return StructType([*fields.fields, StructField(BAD_RECORD, StringType())])


def split_records(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows read with `permissive`, as (good rows, rejects): a reject is its ``record``, the ``file`` it came from and ``parsed``,
    the fields that could be read as JSON."""
    fields = [c for c in df.columns if c != BAD_RECORD]
    good = df.where(F.col(BAD_RECORD).isNull()).select(*fields)
    bad = df.where(F.col(BAD_RECORD).isNotNull()).select(
        F.col(BAD_RECORD).alias("record"), F.input_file_name().alias("file"), F.to_json(F.struct(*fields)).alias("parsed"))
    return good, bad


def ingest_csv(spark: SparkSession, src: str, schema: StructType | str,
               dst: str | None = None, mode: str = "overwrite",
               partition_by: Sequence[str] | None = None, rejects: str | None = None) -> DataFrame:
    """Bring header CSV files in with an explicit schema (no inference).

    With ``dst`` the rows are written as Parquet (optionally partitioned, so
    later date filters prune whole folders) and the Parquet copy is returned.
    A record that doesn't fit the schema (a field too many or too few, a value of another type) fails the ingest; with ``rejects`` it
    goes to the Parquet table of that path (record, file, parsed) and the others are kept.  ``rejects`` needs ``dst``: only
    when all fields are read is a record judged as a whole.
    """
    reader = spark.read.option("header", True)
    if rejects is None:
        df = reader.schema(schema).option("mode", "FAILFAST").csv(src)
    elif dst is None:
        raise ValueError("rejects need a destination for the good rows")
    else:
        every = reader.schema(permissive(schema)).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_RECORD).csv(src)
        df, bad = split_records(every)
        bad.write.mode(mode).parquet(rejects)
    if dst is None:
        return df
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(dst)
    return spark.read.parquet(dst)
