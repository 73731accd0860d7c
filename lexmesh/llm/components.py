"""Connected components of links by alternating large and small stars, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, tidy

ROUNDS = 60


def connected(links: DataFrame) -> DataFrame:
    """From links (a, b): (node, component), the component being the smallest node that is reachable.

    Nodes without links aren't listed. Each round turns neighbourhoods into stars about their smallest
    node; the links are checkpointed, and the rounds end when nothing changes.
    """
    edges = cut(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    for _ in range(ROUNDS):
        now = edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
        if now == state or now[0] == 0:
            break
        state = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        tidy(edges.sparkSession)
    else:
        raise RuntimeError(f"links still change after {ROUNDS} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
