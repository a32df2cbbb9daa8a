"""regioncast: daily counts by region, forecast and clustered, as Spark DataFrame plans.

Subpackages
-----------
sources    scans of the input tables and saved results
sinks      Parquet / CSV writers, compaction, bounded previews
functions  column expressions (calendar, names, arithmetic)
operators  DataFrame -> DataFrame building blocks (filters, aggregates,
           month qualification, gap filling, regression, top-n, clustering,
           versioned cell tables)
plans      the composite queries built from the operators
streaming  incremental file ingest with Structured Streaming

Top-level modules: ``session`` (session defaults, shared folder), ``schemas``
(result schemas), ``catalog`` (registered queries over the driver tables) and
``oracle`` (their DuckDB SQL).
"""

__version__ = "0.1.0"
