"""Connected components of a link table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regioncast.llm.common import stored


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node reachable.

    Alternating star contraction: each round points the larger neighbours of every
    node at its smallest neighbour, then the smaller ones, until the links are
    stars.  Each step's links are a table in the shared folder.  Smallest
    neighbours are aggregated before the shuffle and written before the join, so a node
    with very many links is an ordinary skewed join, which Spark splits.
    Links of a node with itself and nulls are ignored; an empty table gives no rows.
    """
    links = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")

    def state(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before = state(links)
    while True:
        # Large star: every neighbour b > u of u points at the smallest of u and its neighbours.
        both = links.select("a", "b").union(links.select("b", "a")).toDF("u", "v")
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        large = stored(large.where("a <> b").distinct(), "links")
        # Small star: every neighbour a < b of b, and b itself, point at the smallest of them.
        least = stored(large.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m")), "least")
        down = large.withColumnRenamed("b", "u").join(least, "u")
        small = down.select(F.col("m").alias("a"), F.col("a").alias("b")).union(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
        links = stored(small.where("a <> b").distinct(), "links")
        after = state(links)
        if after == before:
            break
        before = after
    stars = links.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return stars.union(links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
