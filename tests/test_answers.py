"""The store of answers, and what an answer returns in order of discovery."""

from pathlib import Path

from pyspark.sql import functions as F

from lexmesh.operators import answers, routing, traversal, vector_index
from lexmesh.plans import answer


def asking(log, fails):
    """A classifier that notes what it is asked, and raises for batches with a text in fails."""

    def classify(texts, candidates):
        with Path(log).open("a") as f:
            f.write("".join(f"{t}\n" for t in texts))
        if set(texts) & set(fails):
            raise RuntimeError("no answer")
        return [c[len(t) % len(c)] for t, c in zip(texts, candidates, strict=True)]

    return classify


def asked(log):
    return sorted(Path(log).read_text().split()) if Path(log).exists() else []


def test_a_second_run_asks_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("a", ["X"], 1), ("bb", ["X", "Y"], 2), ("a", ["X"], 3), ("a", ["Z"], 4)], "text string, options array<string>, question_key int")
    store = answers.create(spark, str(tmp_path / "s"))
    got = store.ask(rows, "text", "options", "answer", asking(tmp_path / "one", []))
    want = [("a", 1, "X"), ("a", 3, "X"), ("a", 4, "Z"), ("bb", 2, "X")]
    assert sorted((r.text, r.question_key, r.answer) for r in got.collect()) == want and got.columns == ["text", "options", "question_key", "answer"]
    assert asked(tmp_path / "one") == ["a", "a", "bb"] and store.asked == 3  # distinct questions
    again = answers.open_store(spark, str(tmp_path / "s"))
    got = again.ask(rows, "text", "options", "answer", asking(tmp_path / "two", []))
    assert sorted((r.text, r.question_key, r.answer) for r in got.collect()) == want
    assert asked(tmp_path / "two") == [] and again.asked == 0


def test_a_failing_batch_is_repeated_alone(spark, tmp_path):
    rows = spark.createDataFrame([(t, ["X"]) for t in ("a", "bad", "c")], "text string, options array<string>")
    store = answers.create(spark, str(tmp_path / "s"))
    one = asking(tmp_path / "one", ["bad"])
    got = store.ask(rows.repartition(3, "text"), "text", "options", "answer", lambda texts, options: [one([t], [o])[0] for t, o in zip(texts, options, strict=True)] if "bad" not in texts else 1 / 0)
    done = {r.text for r in got.collect() if r.answer}
    assert "bad" not in done
    left = {"a", "bad", "c"} - done  # its batch
    assert {r.question: r.times for r in store.failed.read().collect()} == dict.fromkeys(left, 1)
    got = store.ask(rows, "text", "options", "answer", asking(tmp_path / "two", []))
    assert {r.text: r.answer for r in got.collect()} == {"a": "X", "bad": "X", "c": "X"}
    assert set(asked(tmp_path / "two")) == left and store.failed.read().count() == 0


def test_relations_are_resolved_from_the_store(spark, tmp_path):
    rows = spark.createDataFrame([("은행", r, "보고서") for r in ("낯선", "모르는", "낯선")], "agent string, verb_root string, patient string")
    routed = routing.route(rows, spark.createDataFrame([], "verb_root string, mapped string, alternatives array<string>, needs_context boolean"), spark.createDataFrame([], "verb_root string, bucket string"))
    store = answers.create(spark, str(tmp_path / "s"))
    reviews = lambda texts, options: ["REVIEWS"] * len(texts)
    for count in (2, 0):
        found = routing.resolve(routed, reviews, asking=store.ask)
        assert [r.edge_type for r in found.collect()] == ["REVIEWS"] * 3 and store.asked == count


EDGES = [("1", "Y", "a", "b"), ("2", "X", "a", "c"), ("3", "X", "c", "b"), ("4", "X", "z", "a")]


def test_discovery_order_and_the_last_path(spark):
    edges = spark.createDataFrame([(*e, "law") for e in EDGES], "id string, edge_type string, src string, dst string, source_law string")
    vertices = spark.createDataFrame([(v, "Concept", None if v == "b" else v) for v in "abcz"], "id string, label string, name string")
    seeds = spark.createDataFrame([("c", 1), ("a", 2), ("gone", 3)], "id string, ord int")
    paths = traversal.expand(seeds, edges, 2).join(seeds.select(F.col("id").alias("seed"), "ord"), "seed")
    nodes = traversal.found_nodes(paths, seeds, vertices).orderBy("place").collect()
    # seeds in their order, then ends of paths: c-3-b comes before a-4-z
    assert [(r.id, r.name, r.place) for r in nodes] == [("c", "c", 1), ("a", "a", 2), ("b", "?", 3), ("z", "z", 4)]
    found = traversal.found_edges(paths, edges, vertices).orderBy("place").collect()
    order, last = [], {}
    for seed in ("c", "a"):
        steps = [(s, d, i, t) for i, t, s, d in EDGES] + [(d, s, i, t) for i, t, s, d in EDGES]
        one = [((i,), t, b) for a, b, i, t in steps if a == seed]
        two = [(p + (i,), t, b) for p, t, end in one for a, b, i, _ in steps if a == end and i not in p]
        for path, _, end in sorted(one + two, key=lambda x: (x[1], len(x[0]), ",".join(x[0]), x[2])):
            for e in path:
                order += [e] if e not in order else []
                last[e] = (seed, end)
    assert [r.id for r in found] == order and {r.id: (r.source, r.target) for r in found} == last
    assert [r.id for r in traversal.found_edges(paths, edges, vertices, 2).orderBy("place").collect()] == order[:2]


def test_a_cut_context_says_so(spark, monkeypatch, tmp_path):
    vertices = spark.createDataFrame([("s", "Concept", "보고"), *((f"v{i}", "Concept", f"n{i}") for i in range(12))], "id string, label string, name string")
    edges = spark.createDataFrame([(f"e{i}", "NOTIFIES", "s", f"v{i}", "은행법", 1, None, "없음", "능동") for i in range(12)], "id string, edge_type string, src string, dst string, source_law string, article_no int, paragraph_no int, modality string, voice string")
    entities = spark.createDataFrame([("s", "보고", "Concept", [1.0, 0.0])], "id string, name string, label string, embedding array<float>")
    relations = spark.createDataFrame([("e0", "s", "v0", [0.0, 1.0])], "id string, source_entity_id string, target_entity_id string, embedding array<float>")
    monkeypatch.setattr(traversal, "MAX_LINES", 5)
    shown = []
    index = vector_index.build(entities, str(tmp_path / "i"))
    got = answer.answer_question(spark, "보고", index, relations, vertices, edges, top_k=1, embed=lambda texts: [[1.0, 0.5]], chat=lambda q, c: shown.append(c) or "ok")
    assert got.context_truncated and len(got.context) == 5 and got.answer == "ok"
    assert shown[0].startswith(got.context[0]) and shown[0].endswith(answer.CUT.format(5))
    assert [n["id"] for n in got.nodes][:2] == ["s", "v0"] and len(got.nodes) == 13 and len(got.edges) == 12
    assert [s["id"] for s in got.seeds] == ["s", "v0"] and got.seeds[1]["name"] == "n0"
