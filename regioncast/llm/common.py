"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math
import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regioncast.session import shared_dir

#: Bytes of text that a Python worker holds at a time (a longer single text is held alone).
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, by any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send the package's modules to the Python workers, once a session (as ``--py-files`` does)."""
    sc = spark.sparkContext
    if any("regioncast-modules" in f for f in sc._jsc.sc().listFiles().mkString(" ").split()):
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="regioncast-"), "regioncast-modules.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(top, "regioncast")):
            for n in sorted(names):
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), top))
    sc.addPyFile(path)


def small_batches(spark: SparkSession) -> None:
    """Make the modules known to the workers, and bound the Arrow batches sent to them by bytes, unless the session does."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write to the shared folder (with options of the Parquet writer) and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, "llm", name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def narrowed(docs: DataFrame, **types: str) -> DataFrame:
    """Only the named columns, cast; extra columns of the input can't clash with an operator's own."""
    return docs.select(*(docs[c].cast(t).alias(c) for c, t in types.items()))


def whole_row(df: DataFrame, *without: str) -> F.Column:
    """All columns as one struct ``row``, but for those named (in any case): an operator's own columns beside it can't clash with them,
    whatever their names.  ``select("row.*")`` gives them back."""
    left_out = {w.lower() for w in without}
    return F.struct(*(F.col(f"`{c.replace('`', '``')}`") for c in df.columns if c.lower() not in left_out)).alias("row")


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of each hold ``limit`` bytes at most, or are a single text."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ends = np.cumsum(lengths(batch.column(column)))
        at = 0
        while at < n:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def lengths(column: pa.Array) -> np.ndarray:
    """Bytes of each text; 0 for null."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def joined_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column one after another, and the n + 1 offsets of its rows (null: empty)."""
    off = np.concatenate([[0], np.cumsum(lengths(column))])
    data = b"".join(x for x in column.to_pylist() if x)
    return np.frombuffer(data, dtype=np.uint8), off


def crc_of_id(doc_id) -> F.Column:
    """crc32 of the id written as decimal text."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def groups_for(rows: int, per_group: int) -> int:
    return max(1, math.ceil(rows / per_group))
