"""A network stored for traversal: vertices and edges numbered by longs, adjacency bucketed by vertex.

`store` writes it once: vertices (vid, id, ...), degrees (vid, degree) and adjacency (a, part, b, eid, edge_type, out), a
row for each end of an edge, in buckets of a. A step of a traversal sends only the paths to the buckets; the
adjacency isn't shuffled again. Where a vertex has more than SPLIT edges the buckets are of (a, part): its edges are dealt to
several parts, which lie in different buckets, and a path that comes to such a vertex goes to each of them.

Edges with an end that isn't a vertex are steps too, as they are of the unstored network: their ends are numbered.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .traversal import HUB_DEGREE, clamp

#: Edges of a vertex in one part, rows of adjacency in a bucket, and buckets at most.
SPLIT, BUCKET_ROWS, MOST_BUCKETS = 1_000_000, 500_000, 4096


@dataclass(frozen=True)
class Network:
    spark: SparkSession
    path: str
    table: str

    @property
    def vertices(self) -> DataFrame:
        """(vid, id): every id that is a vertex or the end of an edge."""
        return self.spark.read.parquet(f"{self.path}/vertices")

    @property
    def degrees(self) -> DataFrame:
        """(vid, degree, parts) of vertices with edges."""
        return self.spark.read.parquet(f"{self.path}/degrees")

    @property
    def adjacency(self) -> DataFrame:
        return self.spark.table(self.table)


def store(edges: DataFrame, path: str, split: int = SPLIT) -> Network:
    """Writes the network of edges (id, edge_type, src, dst) below path."""
    spark = edges.sparkSession
    table = f"adjacency_{uuid.uuid4().hex}"
    # numbers are given as the rows are written, and hold from there on
    edges.select("edge_type", "src", "dst").withColumn("eid", F.monotonically_increasing_id()).write.parquet(f"{path}/edges")
    numbered = spark.read.parquet(f"{path}/edges")
    ends = numbered.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    ends.withColumn("vid", F.monotonically_increasing_id()).write.parquet(f"{path}/vertices")
    net = Network(spark, path, table)
    end = lambda k: net.vertices.select(F.col("id").alias(k), F.col("vid").alias(f"{k}_vid"))
    joined = numbered.join(end("src"), "src").join(end("dst"), "dst").select("eid", "edge_type", F.col("src_vid").alias("a"), F.col("dst_vid").alias("b"))
    joined.write.parquet(f"{path}/ends")
    ends = spark.read.parquet(f"{path}/ends")
    # a loop is one edge at its vertex, though a step out of it and a step into it
    both = ends.select("a", "b", "eid", "edge_type", F.lit(True).alias("out")).unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"), "eid", "edge_type", F.lit(False).alias("out")))
    count = F.count_if(F.col("out") | (F.col("a") != F.col("b")))
    parts = (1 + F.floor((F.col("degree") - 1) / split)).cast("int")
    both.groupBy(F.col("a").alias("vid")).agg(count.alias("degree")).withColumn("parts", parts).write.parquet(f"{path}/degrees")
    many = net.degrees.filter("parts > 1").select(F.col("vid").alias("a"), "parts")
    by = ["a"] if many.isEmpty() else ["a", "part"]
    dealt = both if by == ["a"] else both.join(many, "a", "left").withColumn("part", F.pmod(F.xxhash64("eid"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    # fewer buckets than a shuffle has partitions, and the planner would rather shuffle
    buckets = min(max(dealt.count() // BUCKET_ROWS + 1, int(spark.conf.get("spark.sql.shuffle.partitions"))), MOST_BUCKETS)
    dealt.repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy("a").option("path", f"{path}/adjacency").saveAsTable(table)
    return net


def degree(net: Network) -> DataFrame:
    """(id, degree): edges at a vertex in either direction."""
    return net.degrees.join(net.vertices, "vid").select("id", "degree")


def numbered(net: Network, seeds: DataFrame) -> DataFrame:
    """seeds (id, ...) with their vid; ids that no edge has are left out."""
    return net.vertices.join(seeds, "id")


def capped(net: Network, seeds: DataFrame, depth: int, hub_degree: int = HUB_DEGREE) -> DataFrame:
    """seeds (id, ...) with their degree and the depth each is expanded to: hubs stop at one step."""
    depth = clamp(depth)
    if depth == 1:
        return seeds.withColumns({"degree": F.lit(None).cast("long"), "depth": F.lit(1)})
    rows = seeds.join(numbered(net, seeds.select("id")).join(net.degrees, "vid").select("id", "degree"), "id", "left")
    return rows.withColumn("degree", F.coalesce("degree", F.lit(0).cast("long"))).withColumn("depth", F.when(F.col("degree") > hub_degree, 1).otherwise(depth))


def expand(net: Network, seeds: DataFrame, depth: int, edge_types: Sequence[str] | None = None, direction: str = "both", one_type: bool | None = None) -> DataFrame:
    """(seed, path, types, last, hops) as traversal.expand, with longs for edges and vertices except the seed."""
    depth = clamp(depth)
    if direction not in ("both", "out", "in"):
        raise ValueError(f"direction is both, out or in, not {direction!r}")
    one_type = bool(edge_types) if one_type is None else one_type
    steps = net.adjacency
    if edge_types:
        steps = steps.filter(F.col("edge_type").isin(*edge_types))
    steps = steps.filter({"both": F.col("out") | (F.col("a") != F.col("b")), "out": F.col("out"), "in": ~F.col("out")}[direction]).drop("out")
    own = F.col("depth") if "depth" in seeds.columns else F.lit(depth)
    start = numbered(net, seeds.select(F.col("id"), own.alias("limit")).distinct())
    many = net.degrees.filter("parts > 1").select("vid", "parts")

    def stepped(paths: DataFrame, at: str) -> DataFrame:
        if "part" not in steps.columns:
            return paths.join(steps.withColumnRenamed("a", at), at)
        parts = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
        dealt = paths.join(many.withColumnRenamed("vid", at), at, "left").withColumn("part", parts).drop("parts")
        return dealt.join(steps.withColumnRenamed("a", at), [at, "part"]).drop("part")

    first = stepped(start.select("vid", F.col("id").alias("seed"), "limit"), "vid")
    now = first.select("seed", "limit", F.array("eid").alias("path"), F.array("edge_type").alias("types"), F.col("b").alias("last"))
    out = now
    for hop in range(2, depth + 1):
        grown = stepped(now.filter(F.col("limit") >= hop), "last")
        fresh = ~F.array_contains("path", F.col("eid"))
        if one_type:
            fresh = fresh & (F.col("edge_type") == F.get("types", F.lit(0)))
        now = grown.filter(fresh).select("seed", "limit", F.array_append("path", F.col("eid")).alias("path"), F.array_append("types", F.col("edge_type")).alias("types"), F.col("b").alias("last"))
        out = out.unionByName(now)
    return out.drop("limit").withColumn("hops", F.size("path"))
