"""Incremental ingest of raw record files (S6) with Structured Streaming.

The reference leaves ingestion to an external flow tool that turns newly
arrived CSV record files into the Parquet inputs.  The Spark-native
equivalent is a file-source stream: each new CSV file in ``src`` is read once
with a fixed schema and appended as Parquet to ``dst``; the checkpoint
records which files are done, so a restarted or re-run job neither skips nor
duplicates a file.  ``available_now`` processes what is there and stops
(a batch-style run); otherwise the stream keeps polling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from regioncast.sources.files import BAD_RECORD, permissive, split_records


def ingest_csv_stream(spark: SparkSession, src: str, schema: StructType | str, dst: str,
                      checkpoint: str, partition_by: Sequence[str] | None = None,
                      available_now: bool = True, max_files_per_trigger: int | None = None,
                      query_name: str | None = None, rejects: str | None = None) -> StreamingQuery:
    """Start the ingest stream and return the running query.

    A record that doesn't fit the schema stops the stream.  With ``rejects`` it goes to the table of that path instead (record, file,
    parsed).  Both tables then get a folder for each micro-batch (partition column ``batch``), written over if the batch is run again, so
    each record stands in one of them once.
    """
    reader = spark.readStream.option("header", True)
    if rejects is None:
        reader = reader.schema(schema).option("mode", "FAILFAST")
    else:
        reader = reader.schema(permissive(schema)).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_RECORD)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    stream = reader.csv(src)

    def both(batch: DataFrame, number: int) -> None:
        good, bad = split_records(batch)
        writer = good.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{dst}/batch={number}")
        bad.write.mode("overwrite").parquet(f"{rejects}/batch={number}")

    writer = stream.writeStream.option("checkpointLocation", checkpoint)
    if rejects is None:
        writer = writer.format("parquet").outputMode("append").option("path", dst)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
    else:
        writer = writer.foreachBatch(both)
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
