"""Stand-in inputs built from the driver's TPC-H-like tables.

The reference's own input files are not public, so each of its four inputs
is played by a view over the given tables with the same shape (FIXTURES.md
section 3; 1997 stands in for 2021).  These builders only shape rows into the
schema the queries expect; the queries' own work happens in ``plans``.

Days are DATE columns cast from the raw timestamps, so the queries' date
windows reach the Parquet scan as bounds on those timestamps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regioncast.functions.calendar import epoch_millis

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(day DATE, total BIGINT, area STRING): order value per day and nation.

    BIGINT rather than the reference's INT: a day's order value per nation
    passes 2^31 at large scale factors.
    """
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = (orders.join(customer, orders.o_custkey == customer.c_custkey)
              .join(nation, F.col("c_nationkey") == F.col("n_nationkey")))
    return (joined
            .groupBy(F.col("o_orderdate").cast("date").alias("day"), F.col("n_name").alias("area"))
            .agg(F.sum(F.floor("o_totalprice").cast("bigint")).alias("total"))
            .select("day", "total", "area"))


def centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(centre BIGINT, area STRING): one row per supplier."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("s_suppkey").alias("centre"), F.col("n_name").alias("area")))


def doses_by_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(day DATE, brand, band, n INT, area): one row per line item.

    Quantity counts on odd line numbers and is 0 on even ones, which gives
    zero-count days for the month qualification rule.
    """
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = (lineitem.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
              .join(nation, F.col("s_nationkey") == F.col("n_nationkey")))
    n = F.when(F.col("l_linenumber") % 2 == 1, F.col("l_quantity").cast("int")).otherwise(F.lit(0))
    return joined.select(
        F.col("l_shipdate").cast("date").alias("day"),
        F.col("l_linestatus").alias("brand"),
        F.col("l_returnflag").alias("band"),
        n.alias("n"),
        F.col("n_name").alias("area"),
    )


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(area STRING, people BIGINT): customers per nation times one million.

    BIGINT: customers x 10^6 passes 2^31 from a few thousand customers per nation.
    """
    customer = table(spark, sf_dir, "customer").select("c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy(F.col("n_name").alias("area"))
            .agg((F.count(F.lit(1)) * 1000000).alias("people")))


def event_cells(spark: SparkSession, sf_dir: str, batch: int | None = None) -> DataFrame:
    """Events as versioned cells with the order in which they were put (``seq``).

    Key user; purchases are in family ``sales``, all other types in ``web``; qualifier event type; the version
    is the event's day (ms), so a cell gets the same version several times; ``seq`` is the event id.  ``batch`` 0 or 1 keeps the events with
    an even or odd id: the two batches of a put.
    """
    ev = table(spark, sf_dir, "events")
    if batch is not None:
        ev = ev.where(F.pmod("event_id", F.lit(2)) == batch)
    return ev.select(
        F.col("user_id").cast("string").alias("row_key"),
        F.when(F.col("event_type") == "purchase", "sales").otherwise("web").alias("family"),
        F.col("event_type").alias("qualifier"),
        epoch_millis(F.col("ts").cast("date")).alias("ts"),
        F.col("value").cast("string").alias("value"),
        F.col("event_id").alias("seq"),
    )
