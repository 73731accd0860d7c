"""The stored network against the unstored one and a plain traversal."""

import random
import re

import pytest

from lexmesh.operators import network, traversal
from lexmesh.plans import queries

SCHEMA = "id string, edge_type string, src string, dst string"


def edges_of(seed, n):
    rng = random.Random(seed)
    return [(f"e{i}", rng.choice("XYZ"), rng.choice("abcdef"), rng.choice("abcdefgh")) for i in range(n)] + [("loop", "X", "a", "a"), ("gone", "Y", "b", "nowhere")]


def brute(rows, depth, seeds, types=None, direction="both", one_type=False):
    ways = [(s, d, i, t) for i, t, s, d in rows if direction != "in"] + [(d, s, i, t) for i, t, s, d in rows if direction == "in" or direction == "both" and s != d]
    ways = [w for w in ways if types is None or w[3] in types]
    out, now = [], [(s, (), (), s) for s in seeds]
    for _ in range(depth):
        now = [(s, p + (i,), ty + (t,), b) for s, p, ty, last in now for a, b, i, t in ways if a == last and i not in p and (not one_type or not ty or t == ty[0])]
        out += now
    return sorted(out)


def stored(spark, rows, path, **how):
    return network.store(spark.createDataFrame(rows, SCHEMA), path, **how)


@pytest.mark.parametrize("split", [1_000_000, 3])
def test_paths_and_degrees(spark, tmp_path, split):
    rows = edges_of(1, 30)
    rows = [(f"{t}{s}{d}", t, s, d) for _, t, s, d in dict.fromkeys((None, t, s, d) for _, t, s, d in rows)]  # an edge is its type and ends
    net = stored(spark, rows, str(tmp_path / "net"), split=split)
    vertex = {r.vid: r.id for r in net.vertices.collect()}
    edge = {r.eid: f"{r.edge_type}{vertex[r.a]}{vertex[r.b]}" for r in spark.read.parquet(f"{net.path}/ends").collect()}
    named = lambda found: sorted((r.seed, tuple(edge[e] for e in r.path), tuple(r.types), vertex[r.last]) for r in found.collect())
    seeds = spark.createDataFrame([("a",), ("c",), ("nobody",)], "id string")
    for how in ({}, {"edge_types": ["X", "Y"]}, {"edge_types": ["X", "Y"], "one_type": False}, {"direction": "out"}, {"direction": "in"}):
        for depth in (1, 2, 3):
            want = brute(rows, depth, ["a", "c"], how.get("edge_types"), how.get("direction", "both"), how.get("one_type", "edge_types" in how))
            assert named(network.expand(net, seeds, depth, **how)) == want, (how, depth)
    edges = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, network.degree(net).collect())) == sorted(map(tuple, traversal.degree(edges).collect()))
    for hub in (3, 8):
        got, want = (sorted((r.id, r.degree, r.depth) for r in f.collect()) for f in (network.capped(net, seeds, 2, hub), traversal.capped(seeds, edges, 2, hub)))
        assert got == want
    own = spark.createDataFrame([("a", 1), ("c", 2)], "id string, depth int")
    assert named(network.expand(net, own, 3)) == sorted(brute(rows, 1, ["a"]) + brute(rows, 2, ["c"]))


def test_parallel_edges_are_edges_of_their_own(spark, tmp_path):
    rows = [(str(i), "X", "a", "b") for i in range(4)]
    net = stored(spark, rows, str(tmp_path / "net"))
    seeds = spark.createDataFrame([("a",)], "id string")
    assert network.expand(net, seeds, 2).groupBy("hops").count().orderBy("hops").collect()[1]["count"] == 12


def test_a_step_does_not_shuffle_the_adjacency(spark, tmp_path):
    """Every exchange of a step's plan lies above paths, none above the scan of the adjacency."""
    net = stored(spark, edges_of(2, 200), str(tmp_path / "net"))
    seeds = spark.createDataFrame([("a",)], "id string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = network.expand(net, seeds, 2)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    lines = plan.split("\n")
    scans = [i for i, x in enumerate(lines) if "FileScan" in x and net.table in x]
    assert len(scans) == 3 and "Bucketed: true" in plan
    for i in scans:
        indent = lambda x: len(re.match(r"[\s:+\-]*", x)[0])
        level, j = indent(lines[i]), i
        while j > 0 and not re.search(r"(SortMergeJoin|ShuffledHashJoin)", lines[j]):  # up to the join that the scan feeds
            if indent(lines[j]) <= level:
                level = indent(lines[j])
                assert "Exchange" not in lines[j], plan
            j -= 1


def test_one_hop_from_all_vertices_shuffles_edges_and_vertices_once(spark, sf):
    """Nothing is stored for it, and its counts need no exchange beside those of the join."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    stored = dict(queries._STORED)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = queries.j08_one_hop(spark, sf)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(re.findall(r"\bExchange\b", plan)) == 2, plan
    assert queries._STORED == stored


@pytest.mark.parametrize("few", [0, 2, 100_000])
def test_few_paths_are_sent_to_the_edges_and_more_are_joined(spark, few, monkeypatch):
    """The same paths and the same context either way; where few are sent, no edge or vertex is shuffled before it is filtered."""
    monkeypatch.setattr(traversal, "FEW", few)
    rows = [(i, t, s, d, "l", 1, 1, "n", "v") for i, t, s, d in [*edges_of(3, 24), ("far", "X", "y", "z")]]
    edges = spark.createDataFrame(rows, f"{SCHEMA}, source_law string, article_no int, paragraph_no int, modality string, voice string")
    vertices = spark.createDataFrame([(v, "Concept", v.upper()) for v in "abcdefgh"], "id string, label string, name string")
    seeds = spark.createDataFrame([("a", 1), ("c", 2)], "id string, depth int")
    paths = traversal.expand(seeds, edges, 3, few=True)
    plain = [r[:4] for r in rows]
    assert sorted((r.seed, tuple(r.path), tuple(r.types), r.last) for r in paths.collect()) == sorted(brute(plain, 1, ["a"]) + brute(plain, 2, ["c"]))
    assert {(r.hops, len(r.path)) for r in paths.collect()} == {(1, 1), (2, 2)}
    near = traversal.reached(paths, edges, vertices)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [x._jdf.queryExecution().executedPlan().toString() for x in near]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert all(("BroadcastHashJoin" in x) == (few > 2) for x in plans), plans
    assert near[0].count() < edges.count()
    both = [[tuple(r) for r in traversal.context(paths, *of, 1000).select("line").collect()] for of in ((edges, vertices), near)]
    assert both[0] == both[1] and both[0]


def test_directions(spark, tmp_path):
    net = stored(spark, [("1", "X", "a", "b")], str(tmp_path / "net"))
    with pytest.raises(ValueError, match="direction"):
        network.expand(net, spark.createDataFrame([("a",)], "id string"), 1, direction="up")


@pytest.mark.parametrize("limit", [1, 7, 40, 10_000])
def test_bounded_context_equals_the_full_one(spark, limit, monkeypatch):
    """The same lines in the same order, with fewer seeds expanded where the limit is reached early."""
    rng = random.Random(limit)
    rows = [(f"e{i}", rng.choice("XYZ"), rng.choice("abcdef"), rng.choice("abcdef"), rng.choice(["l", "m"]), rng.choice([1, 2])) for i in range(24)]
    edges = spark.createDataFrame(rows, f"{SCHEMA}, source_law string, article_no int").selectExpr("*", "1 AS paragraph_no", "'n' AS modality", "'v' AS voice").cache()
    vertices = spark.createDataFrame([(v, "Concept", v.upper()) for v in "abcdef"], "id string, label string, name string")
    seeds = spark.createDataFrame([("c", 2), ("a", 1), ("f", 2), ("b", 2)], "id string, depth int")
    want = [r.line for r in traversal.context(traversal.expand(seeds, edges, 2), edges, vertices, limit).collect()]
    expanded = []
    full = traversal.expand
    monkeypatch.setattr(traversal, "expand", lambda some, *a, **k: expanded.append(some.count()) or full(some, *a, **k))
    got = [r.line for r in traversal.bounded_context(seeds, edges, vertices, 2, limit).orderBy("place").collect()]
    assert got == want
    assert sum(expanded) == {1: 1, 10_000: 4}.get(limit, sum(expanded))
