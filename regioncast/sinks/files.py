"""Writers: Parquet results, CSV copies, compaction, cell tables, previews (K1-K6).

A result is always a folder of part files, written and read as a whole:
nothing is renamed and no single part file is assumed (B10).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a Parquet file that compaction aims at.
FILE_BYTES = 128 << 20


def write_result(df: DataFrame, folder: str, name: str, mode: str = "overwrite",
                 partition_by: list[str] | None = None) -> str:
    """Save as Parquet under ``folder/name`` (K1, K2 with ``mode="append"``)."""
    path = f"{folder.rstrip('/')}/{name}"
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_csv(df: DataFrame, folder: str, name: str, mode: str = "overwrite") -> str:
    """Save as header CSV for inspection (K4)."""
    path = f"{folder.rstrip('/')}/{name}"
    df.write.mode(mode).option("header", True).csv(path)
    return path


def listed_bytes(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> int:
    """Total size of a folder's files, subfolders too, as the file system lists them; no file is opened."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
             .load(folder).select("length"))
    return files.agg(F.sum("length")).first()[0] or 0


def compact(spark: SparkSession, src: str, dst: str, num_files: int | None = None,
            rows_per_file: int | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Rewrite the Parquet folder ``src`` into files of about ``file_bytes`` at ``dst`` (K3).

    The number of files is the listed size of ``src`` over ``file_bytes``, whatever the rows' width; ``num_files`` fixes it
    (1 reproduces the reference).  Rows are dealt evenly, so the read stays parallel and no row is counted.
    ``rows_per_file`` also bounds the rows of a file.  ``src`` is left in place for the caller.
    """
    if src.rstrip("/") == dst.rstrip("/"):
        raise ValueError("compact: source and destination must differ")
    if num_files is None:
        num_files = max(1, round(listed_bytes(spark, src) / file_bytes))
    writer = spark.read.parquet(src).repartition(num_files).write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(dst)
    return spark.read.parquet(dst)


def write_cells(cells: DataFrame, folder: str, table: str, mode: str = "overwrite") -> str:
    """Store a cell table (K6: ``overwrite`` drops and recreates it)."""
    return write_result(cells, folder, table, mode=mode)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """Print the first ``n`` rows (K5) and return them; never an unbounded collect."""
    df.show(n, truncate=False)
    return df.limit(n)
