"""Bounded traversal of a typed network of parallel edges, held as vertices (id, label, name) and edges (id, edge_type, src, dst, ...).

Paths are grown by joins on ids alone; a path never repeats an edge, but may return to a vertex, and every
path is a row. Vertices are joined once, at the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import context_line, plain_line
from ..sources import sinks

MAX_DEPTH, HUB_DEGREE = 3, 300
MAX_LINES, MAX_NODES, MAX_EDGES = 300, 1000, 1500
#: Paths or ids that are sent to the edges or vertices, at most. Of more, both sides are shuffled.
FEW = 100_000


def clamp(depth: int) -> int:
    return max(1, min(depth, MAX_DEPTH))


def adjacency(edges: DataFrame, direction: str = "both", edge_types: Sequence[str] | None = None) -> DataFrame:
    """(a, b, edge_id, edge_type): steps in the direction. A self-loop is one step, also in both directions."""
    if edge_types:
        edges = edges.filter(F.col("edge_type").isin(*edge_types))
    step = lambda a, b: F.struct(F.col(a).alias("a"), F.col(b).alias("b"))
    if direction not in ("both", "out", "in"):
        raise ValueError(f"direction is both, out or in, not {direction!r}")
    if direction == "both":
        # both ways of an edge come from one scan
        ways = F.when(F.col("src") == F.col("dst"), F.array(step("src", "dst"))).otherwise(F.array(step("src", "dst"), step("dst", "src")))
        return edges.select(F.inline(ways), F.col("id").alias("edge_id"), "edge_type")
    a, b = ("src", "dst") if direction == "out" else ("dst", "src")
    return edges.select(F.col(a).alias("a"), F.col(b).alias("b"), F.col("id").alias("edge_id"), "edge_type")


def degree(edges: DataFrame) -> DataFrame:
    """(id, degree): edges at a vertex in either direction."""
    return adjacency(edges).groupBy(F.col("a").alias("id")).agg(F.count("*").alias("degree"))


def capped(seeds: DataFrame, edges: DataFrame, depth: int, hub_degree: int = HUB_DEGREE, few: bool = False) -> DataFrame:
    """seeds (id, ...) with the depth each is expanded to: hubs stop at one step. Edges of other vertices aren't counted.

    few: seeds are a bounded top-k, and are sent to the edges.
    """
    depth = clamp(depth)
    if depth == 1:
        return seeds.withColumns({"degree": F.lit(None).cast("long"), "depth": F.lit(1)})
    ids = seeds.select(F.col("id").alias("a")).distinct()
    steps = adjacency(edges).join(F.broadcast(ids) if few else ids, "a", "left_semi")
    degrees = steps.groupBy(F.col("a").alias("id")).agg(F.count("*").alias("degree"))
    return seeds.join(degrees, "id", "left").withColumn("degree", F.coalesce("degree", F.lit(0))).withColumn("depth", F.when(F.col("degree") > hub_degree, 1).otherwise(depth))


def held(rows: DataFrame) -> DataFrame:
    """rows, computed once and written below the shared folder."""
    path = sinks.shared_folder(rows.sparkSession)
    sinks.snapshot(rows, path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def sent(rows: DataFrame) -> DataFrame:
    """rows, sent to what they are joined with if they are few."""
    return F.broadcast(rows) if rows.count() <= FEW else rows


def expand(seeds: DataFrame, edges: DataFrame, depth: int, edge_types: Sequence[str] | None = None, direction: str = "both", one_type: bool | None = None, few: bool = False) -> DataFrame:
    """(seed, path, types, last, hops): all paths of 1..depth steps from seeds (id[, depth]).

    A column depth of the seeds bounds each. With edge_types a path keeps the type it began with, unless one_type is False.
    few: seeds are a bounded top-k, and the first step sends them to the edges; what a step finds is written, and sent to them too while
    it is few.
    """
    depth = clamp(depth)
    one_type = bool(edge_types) if one_type is None else one_type
    steps = adjacency(edges, direction, edge_types)
    own = F.col("depth") if "depth" in seeds.columns else F.lit(depth)
    # distinct in ids alone where it can be: then it is dealt as the join is
    start = seeds.select("id", *(c for c in ("depth",) if c in seeds.columns)).distinct().select(F.col("id").alias("seed"), own.alias("_depth"))
    start = F.broadcast(start) if few else start
    now = start.join(steps, F.col("seed") == F.col("a")).select("seed", "_depth", F.array("edge_id").alias("path"), F.array("edge_type").alias("types"), F.col("b").alias("last"))
    found = [now]
    for hop in range(2, depth + 1):
        if few:
            now = found[-1] = held(now)
        going = now.filter(F.col("_depth") >= hop)
        grown = (sent(going) if few else going).join(steps, F.col("last") == F.col("a"))
        fresh = ~F.array_contains("path", F.col("edge_id"))
        if one_type:
            fresh = fresh & (F.col("edge_type") == F.get("types", F.lit(0)))
        now = grown.filter(fresh).select("seed", "_depth", F.array_append("path", F.col("edge_id")).alias("path"), F.array_append("types", F.col("edge_type")).alias("types"), F.col("b").alias("last"))
        found.append(now)
    # a length that is known beforehand, so a count of paths need not carry their edges
    found = [x.drop("_depth").withColumn("hops", F.lit(hop)) for hop, x in enumerate(found, 1)]
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out


def with_ends(paths: DataFrame, vertices: DataFrame) -> DataFrame:
    """Labels and names of both ends; paths with a missing end go."""
    end = lambda side: vertices.select(F.col("id").alias(side), F.col("label").alias(f"{side}_label"), F.col("name").alias(f"{side}_name"))
    return paths.join(end("seed"), "seed").join(end("last"), "last")


def path_edges(paths: DataFrame, edges: DataFrame) -> DataFrame:
    """A row per edge of a path, with its own ends (edge_src, edge_dst) beside those of the path (seed, last)."""
    each = paths.select("*", F.posexplode("path").alias("place", "edge_id"))
    facts = edges.withColumnsRenamed({"id": "edge_id", "src": "edge_src", "dst": "edge_dst"})
    return each.join(facts, "edge_id")


def path_order(columns: Sequence[str] = ()) -> list[Column]:
    """A fixed order of discovery: seed, or the seed's place `ord` where there is one, type, length, path."""
    return [F.col("ord" if "ord" in columns else "seed"), F.get("types", F.lit(0)), F.col("hops"), F.array_join("path", ","), F.col("last")]


def _ordered(columns: Sequence[str], *more: str) -> Column:
    return F.struct(*(c.alias(f"k{i}") for i, c in enumerate([*path_order(columns), *map(F.col, more)])))


def context(paths: DataFrame, edges: DataFrame, vertices: DataFrame, limit: int = MAX_LINES) -> DataFrame:
    """(line, position): distinct context lines in order of discovery, the first `limit`."""
    rows = path_edges(with_ends(paths, vertices), edges)
    line = context_line(F.col("source_law"), F.col("article_no"), F.col("paragraph_no"), F.col("seed_name"), F.col("edge_type"), F.col("last_name"), F.col("modality"), F.col("voice"))
    first = rows.select(line.alias("line"), _ordered(paths.columns, "place").alias("at")).groupBy("line").agg(F.min("at").alias("at"))
    return first.orderBy("at", "line").limit(limit)


def reached(paths: DataFrame, edges: DataFrame, vertices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edges on paths and the vertices at their ends. Where these are few, their ids are sent to the tables, which aren't shuffled then."""
    ids = lambda *columns: held(paths.select(F.explode(*columns).alias("id")).distinct())
    some = lambda rows, of: rows.join(sent(of), "id", "left_semi")
    return some(edges, ids("path")), some(vertices, ids(F.array("seed", "last")))


def bounded_context(seeds: DataFrame, edges: DataFrame, vertices: DataFrame, depth: int, limit: int = MAX_LINES, **how) -> DataFrame:
    """(line, place): the lines of context over expand(seeds, edges, depth, **how), but seeds are expanded only until `limit` lines are found.

    The order of discovery begins with the seed, so lines of later seeds can't come before those of earlier ones.
    seeds are a bounded top-k; they are taken in batches that double.
    """
    seeds = seeds.sparkSession.createDataFrame(seeds.collect(), seeds.schema)  # computed once
    ids = [r.id for r in seeds.select("id").distinct().orderBy("id").collect()]
    lines: dict[str, None] = {}
    at, size = 0, 1
    while at < len(ids) and len(lines) < limit:
        some = seeds.filter(F.col("id").isin(ids[at : at + size]))
        paths = held(expand(some, edges, depth, few=True, **how))
        # of its first lines some may have been found before
        got = context(paths, *reached(paths, edges, vertices), limit + len(lines)).collect()
        lines |= dict.fromkeys(r.line for r in got)
        at, size = at + size, 2 * size
    return seeds.sparkSession.createDataFrame([(line, i + 1) for i, line in enumerate(list(lines)[:limit])], "line string, place int")


def found_nodes(paths: DataFrame, seeds: DataFrame, vertices: DataFrame, limit: int = MAX_NODES) -> DataFrame:
    """(id, label, name, place): the first vertices in order of discovery: seeds (id, ord) that are vertices, then the ends of paths.

    paths have the `ord` of their seed. A missing name or label is `?`.
    """
    ends = with_ends(paths, vertices)
    start = seeds.select("id", F.lit(0).alias("later"), F.struct("ord", *(F.lit(x).cast(k).alias(f"k{i}") for i, (x, k) in enumerate((("", "string"), (0, "int"), ("", "string"), ("", "string")), 1))).alias("at"))
    rest = ends.select(F.col("last").alias("id"), F.lit(1).alias("later"), _ordered(paths.columns).alias("at"))
    same = rest.schema["at"].dataType
    first = start.withColumn("at", F.col("at").cast(same)).unionByName(rest).groupBy("id").agg(F.min(F.struct("later", "at")).alias("at"))
    kept = first.join(vertices, "id").orderBy("at").limit(limit)
    return kept.select("id", F.coalesce("label", F.lit("?")).alias("label"), F.coalesce("name", F.lit("?")).alias("name"), F.row_number().over(Window.orderBy("at")).alias("place"))


def found_edges(paths: DataFrame, edges: DataFrame, vertices: DataFrame, limit: int = MAX_EDGES) -> DataFrame:
    """(id, source, target, the columns of edges, place): the first edges in order of discovery.

    An edge is placed where it is met first, and has the ends of the path that it is met on last.
    """
    rows = path_edges(with_ends(paths, vertices), edges)
    facts = [c for c in edges.columns if c not in ("id", "src", "dst")]
    each = rows.select(F.col("edge_id").alias("id"), F.struct(F.col("seed").alias("source"), F.col("last").alias("target"), *facts).alias("e"), _ordered(paths.columns, "place").alias("at"))
    kept = each.groupBy("id").agg(F.min("at").alias("first"), F.max_by("e", "at").alias("e")).orderBy("first").limit(limit)
    return kept.select("id", "e.*", F.row_number().over(Window.orderBy("first")).alias("place")).withColumn("edge_type", F.coalesce("edge_type", F.lit("?")))


def plain_context(paths: DataFrame, edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """(line): distinct plain lines; a vertex without a name goes by its id."""
    named = vertices.withColumn("name", F.coalesce("name", "id", F.lit("?")))
    rows = path_edges(with_ends(paths, named), edges)
    return rows.select(plain_line(F.col("seed_label"), F.col("seed_name"), F.col("edge_type"), F.col("last_label"), F.col("last_name")).alias("line")).distinct()


def by_id(vertices: DataFrame, ids: DataFrame) -> DataFrame:
    """The vertices of a bounded set of ids (id), which is sent to them."""
    return vertices.join(F.broadcast(ids.select("id").distinct()), "id", "left_semi")


def find_by_name(vertices: DataFrame, name: str, labels: Sequence[str]) -> DataFrame:
    """The first vertex of that name: labels in order, then the id."""
    rank = F.array_position(F.array(*map(F.lit, labels)), F.col("label"))
    return vertices.filter((F.col("name") == name) & (rank > 0)).orderBy(rank, "id").limit(1)


def resolved_edges(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Edges whose both ends exist."""
    ids = vertices.select("id")
    return edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")


def collapse_parallel(edges: DataFrame) -> DataFrame:
    """One edge for each (src, edge_type, dst), of the largest id."""
    return edges.groupBy("src", "edge_type", "dst").agg(F.max("id").alias("id"), F.count("*").alias("n"))
