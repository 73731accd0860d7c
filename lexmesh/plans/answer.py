"""Answering a question: seeds, routing, bounded traversal, context. What is collected is bounded by the caps."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import ordering, routing, traversal, vector_index, vectors

# Fixed value: the answer without evidence.
NOTHING = "그래프에서 이 질문과 관련된 근거를 찾지 못했습니다."
# Fixed value: what stands behind a context that was cut.
CUT = "\n\n[참고: 탐색된 관계가 너무 많아 상위 {}개만 표시함 — 답변이 불완전할 수 있음]"


@dataclass
class Answer:
    answer: str
    seeds: list[dict] = field(default_factory=list)
    nodes: list[dict] = field(default_factory=list)
    edges: list[dict] = field(default_factory=list)
    context: list[str] = field(default_factory=list)
    context_truncated: bool = False
    edge_types: list[str] | None = None
    edge_type_source: str | None = None
    edge_type_refined: bool = False
    hub_seeds_capped: int = 0


def traverse(seeds: DataFrame, edges: DataFrame, depth: int, edge_types: Sequence[str] | None) -> tuple[DataFrame, bool]:
    """Paths from seeds (id), hubs capped; without a filter if the filter leaves none. The flag says if the filter held."""
    bounded = traversal.capped(seeds.select("id").distinct(), edges, depth, few=True).select("id", "depth")  # at most three times top_k seeds
    if edge_types:
        paths = traversal.expand(bounded, edges, depth, edge_types, few=True)
        if not paths.isEmpty():
            return paths, True
    return traversal.expand(bounded, edges, depth, few=True), False


Searched = DataFrame | vector_index.Index


def hits(searched: Searched, query: list[float], top_k: int) -> DataFrame:
    """The rows nearest to the query, from a table of vectors or from an index of them."""
    return vector_index.search(searched, query, top_k) if isinstance(searched, vector_index.Index) else vectors.nearest(searched, query, top_k)


def seed_rows(entities: Searched, relations: Searched, query: list[float], top_k: int) -> DataFrame:
    """(id, name, label, score, ord): entity hits first, then the ends of relation hits; the first of an id counts."""
    near = hits(entities, query, top_k).select("id", "name", "label", "score", F.struct((-F.col("score")).alias("s"), F.col("id").alias("r"), F.lit(0).alias("side")).alias("o"))
    ends = hits(relations, query, top_k).select(F.col("id").alias("rid"), "score", F.posexplode(F.array("source_entity_id", "target_entity_id")).alias("side", "id"))
    none = F.lit(None).cast("string")
    return union_seeds(near, ends.select("id", none.alias("name"), none.alias("label"), "score", F.struct((-F.col("score")).alias("s"), F.col("rid").alias("r"), "side").alias("o")))


def union_seeds(near: DataFrame, ends: DataFrame) -> DataFrame:
    """The rows of both with their order o; the first of an id counts, and those of ends come behind all others."""
    later = lambda rows, k: rows.withColumn("o", F.struct(F.lit(k).alias("later"), F.col("o").alias("at")))
    return ordering.first_wins(later(near, 0).unionByName(later(ends, 1)), "id", "o")


def answer_question(
    spark: SparkSession, question: str, entities: Searched, relations: Searched, vertices: DataFrame, edges: DataFrame, *, top_k: int = 5, depth: int = 1,
    embed: Callable = vectors.hashed, categories: Callable[[str], list[str]] = lambda q: [], refine: Callable[[str, list[str]], list[str]] = lambda q, c: c, chat: Callable[[str, str], str] = lambda q, context: context,
) -> Answer:
    """entities (id, name, label, embedding) and relations (id, source_entity_id, target_entity_id, embedding), or indexes of them, are searched, the network expanded.

    chat gets the question and the context, with a note behind it where it was cut.
    """
    if not question or not 1 <= top_k <= 20 or not 1 <= depth <= 3:
        raise ValueError("a question, top_k of 1 to 20 and a depth of 1 to 3 are needed")
    order = Window.orderBy("o")  # of at most three times top_k seeds
    seeds = seed_rows(entities, relations, [float(x) for x in embed([question])[0]], top_k).withColumn("ord", F.row_number().over(order)).drop("o")
    one = spark.createDataFrame([(question,)], "q string")
    types = one.select(routing.hinted_types(F.col("q"))).first()[0]
    source, narrowed = ("keyword" if types else None), False
    if not types:
        chosen = one.select(routing.category_types(F.lit(categories(question)).cast("array<string>"))).first()[0]
        if chosen:
            got = [t for t in dict.fromkeys(refine(question, chosen)) if t in chosen] or chosen
            types, source, narrowed = got, "llm_category", got != chosen
    paths, held = traverse(seeds, edges, depth, types)
    paths = paths.join(F.broadcast(seeds.select(F.col("id").alias("seed"), "ord")), "seed").persist()  # read by the context, the edges and the nodes
    if types and not held:
        types, source, narrowed = None, None, False
    lines = [r["line"] for r in traversal.context(paths, edges, vertices, traversal.MAX_LINES + 1).collect()]
    cut = len(lines) > traversal.MAX_LINES
    lines = lines[: traversal.MAX_LINES]
    nodes = traversal.found_nodes(paths, seeds, vertices).orderBy("place").drop("place")
    found = traversal.found_edges(paths, edges, vertices).orderBy("place").drop("place")
    named = seeds.join(vertices.select("id", F.col("name").alias("n"), F.col("label").alias("l")), "id", "left").orderBy("ord").select("id", F.coalesce("name", "n").alias("name"), F.coalesce("label", "l").alias("label"), "score")
    capped = traversal.capped(seeds.select("id"), edges, depth).filter(F.col("depth") < depth).count()
    rows = lambda df: [r.asDict(True) for r in df.collect()]
    shown = "\n".join(lines) + (CUT.format(traversal.MAX_LINES) if cut else "")
    out = Answer(chat(question, shown) if lines else NOTHING, rows(named), rows(nodes), rows(found), lines, cut, types, source, narrowed, capped)
    paths.unpersist()
    return out
