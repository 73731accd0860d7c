"""Rules on small fixtures."""

import random

import pytest
from pyspark.sql import functions as F

from lexmesh.functions import names as N
from lexmesh.functions import vocab
from lexmesh.operators import clauses, ordering, routing, structure, traversal, upserts, vectors
from lexmesh.plans import answer, build
from lexmesh.sources import readers, sinks


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x"))).first()[0]


def test_categories_partition_the_edge_types():
    assert len(vocab.EDGE_TYPES) == len(set(vocab.EDGE_TYPES)) == 64
    assert {t for ts in vocab.KEYWORDS.values() for t in ts} <= set(vocab.EDGE_TYPES)


@pytest.mark.parametrize(("name", "want"), [("경우금융위원회", "금융위원회"), ("금융위원회", "금융위원회"), ("한국은행총재", "한국은행총재"), ("아무금융위원회", "아무금융위원회"), ("금융위", "금융위원회"), ("등감사원", "감사원")])
def test_alias(spark, name, want):
    assert one(spark, name, N.resolve_alias) == want


@pytest.mark.parametrize(("name", "want"), [("은행 법", "은행법"), ("감사원·장, 규칙", "감사원ㆍ장ㆍ규칙")])
def test_normalize(spark, name, want):
    assert one(spark, name, N.normalize) == want


@pytest.mark.parametrize(("name", "label", "subtype"), [("은행법", "LegalDocument", "법령"), ("불법", "Concept", None), ("감사위원장", "Person", "위원장"), ("국세청", "Organization", "청"), ("내부통제", "Concept", "내부통제"), ("이름", "Concept", None), ("법", "Concept", None)])
def test_types(spark, name, label, subtype):
    got = one(spark, name, N.typed)
    assert (got.label, got.subtype) == (label, subtype)


@pytest.mark.parametrize(("lemma", "root"), [("선임하다", "선임"), ("하다", "하다"), ("준수되다", "준수"), ("크다", "크다"), ("인정받다", "인정")])
def test_roots(spark, lemma, root):
    assert one(spark, lemma, N.extract_root) == root


def test_keywords(spark):
    assert one(spark, "임원을 재직하게", routing.hinted_types) == ["WORKS_AT"]
    assert one(spark, "합병과 분할", routing.hinted_types) == ["DIVIDES_INTO", "MERGES_WITH"]
    assert one(spark, "날씨", routing.hinted_types) is None


def test_refinement_keeps_candidates(spark):
    ask = lambda c, a: spark.createDataFrame([(c, a)], "c array<string>, a array<string>").select(routing.refined(F.col("c"), F.col("a"))).first()[0]
    assert ask(["A", "B"], ["B"]) == ["B"]
    assert ask(["A", "B"], ["C", "A"]) == ["A"]
    assert ask(["A", "B"], []) == ask(["A", "B"], None) == ["A", "B"]


EDGES = [("1", "X", "a", "b"), ("2", "X", "a", "b"), ("3", "Y", "b", "c"), ("4", "X", "c", "a"), ("5", "X", "a", "a"), ("6", "X", "b", "gone")]


@pytest.fixture
def edges(spark):
    return spark.createDataFrame(EDGES, "id string, edge_type string, src string, dst string")


def brute(depth, seeds, homogeneous=False):
    steps = [(s, d, i, t) for i, t, s, d in EDGES] + [(d, s, i, t) for i, t, s, d in EDGES if s != d]
    out, now = [], [(s, (), (), s) for s in seeds]
    for _ in range(depth):
        now = [(s, p + (i,), ty + (t,), b) for s, p, ty, last in now for a, b, i, t in steps if a == last and i not in p and (not homogeneous or not ty or t == ty[0])]
        out += now
    return sorted(out)


@pytest.mark.parametrize("depth", [1, 2, 3])
@pytest.mark.parametrize("homogeneous", [False, True])
def test_paths(spark, edges, depth, homogeneous):
    seeds = spark.createDataFrame([("a",), ("c",)], "id string")
    got = traversal.expand(seeds, edges, depth, one_type=homogeneous).collect()
    assert sorted((r.seed, tuple(r.path), tuple(r.types), r.last) for r in got) == brute(depth, ["a", "c"], homogeneous)


def test_degree_and_hubs(spark, edges):
    got = {r.id: r.degree for r in traversal.degree(edges).collect()}
    assert got == {"a": 4, "b": 4, "c": 2, "gone": 1}
    seeds = spark.createDataFrame([("a",), ("c",), ("none",)], "id string")
    assert {r.id: r.depth for r in traversal.capped(seeds, edges, 2, 3).collect()} == {"a": 1, "c": 2, "none": 2}
    assert traversal.clamp(9) == 3 and traversal.clamp(0) == 1


def test_first_and_last(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("a", 3, "z")], "k string, o int, v string")
    assert {(r.k, r.v) for r in ordering.first_wins(rows, "k", "o").collect()} == {("a", "x"), ("b", "y")}
    assert {(r.k, r.v, r.first_seen) for r in ordering.last_wins(rows, "k", "o").collect()} == {("a", "z", 1), ("b", "y", 2)}


TEXT = """---
title: 은행법
---
# 제1장
##### 제17조의2 (정의)
**①** 머리 <개정 2009.1.30>
  1\\. 첫째
    가\\. 하나
뒤의 말
**㉑** 둘째 항
##### 제18조
없는 제목
## 부칙
##### 제1조 (시행일)
버린다
"""


def test_structure(spark):
    docs = spark.createDataFrame([("d", TEXT), ("e", "")], "d string, raw_text string")
    found = structure.articles(docs)
    assert [(r.d, r.article_no, r.article_sub_no, r.title) for r in found.collect()] == [("d", 17, 2, "정의")]
    units = [(r.paragraph_no, r.unit_text, r.item_depth) for r in structure.units(structure.paragraphs(found)).orderBy("paragraph_ord", "unit_ord").collect()]
    assert units[:3] == [(1, "머리", -1), (1, "첫째", 0), (1, "하나", 1)]
    assert units[3][0] == 21 and units[3][1].startswith("둘째 항")


def toks(text):
    return [tuple(x.rsplit("/", 1)) for x in text.split()]


CASES = {
    "topic": "은행/NNG 는/JX 보고서/NNG 를/JKO 제출/NNG 하/XSV 어야/EC 하/VX ㄴ다/EF",
    "passive": "감사/NNG 가/JKS 법원/NNP 에/JKB 의하/VV 어/EC 해임/NNG 되/XSV ㄴ다/EF",
    "no by-phrase": "감사/NNG 가/JKS 해임/NNG 되/XSV 지/EC 아니하/VX ㄴ다/EF",
    "later subject": "승인/NNG 을/JKO 요청/NNG 하/XSV 고/EC 은행/NNG 이/JKS 제출/NNG 하/XSV ㄹ/ETM 수/NNB 있/VA 다/EF 이사/NNG 선임/NNG 하/XSV",
    "nounless": "이/JKS 제출/NNG 하/XSV",
}


def test_clauses_fold_and_windows_agree(spark):
    rows = [(a, i, toks(t)) for a, order in enumerate((list(CASES), list(CASES)[::-1])) for i, t in enumerate(CASES[k] for k in order)]
    units = spark.createDataFrame(rows, "article int, unit_ord int, tokens array<struct<form: string, tag: string>>")
    columns = ["article", "unit_ord", "pos", "verb_lemma", "agent", "patient", "voice", "modality", "agent_source"]
    a, b = (sorted(map(str, f(units, ["article"]).select(*columns).collect())) for f in (clauses.extract, clauses.fold))
    assert a == b
    got = {(r.article, r.unit_ord, r.verb_lemma): (r.agent, r.patient, r.modality, r.agent_source) for r in clauses.extract(units, ["article"]).collect()}
    assert got[0, 0, "제출하다"] == ("은행", "보고서", "의무", "TOPIC")
    assert got[0, 1, "해임되다"] == ("법원", "감사", "없음", "JKB(의하여)")
    assert got[0, 2, "해임되다"] == (None, "감사", "금지", "JKS")
    assert got[0, 3, "제출하다"][2:] == ("재량", "JKS")


def test_clause_text(spark):
    row = spark.createDataFrame([("", "제출하다", None, "x" * 300)], "a string, v string, p string, e string")
    got = row.select(N.clause_text(F.col("a"), F.col("v"), F.col("p"), F.col("e"), F.lit(7))).first()[0]
    assert got == f"[7] 주어=(생략) / 동사=제출하다 / 목적어=(생략) / 원문: {'x' * 200}"


@pytest.mark.parametrize(("text", "want"), [("2020-01-31", "2020-01-31"), (" 2020-01-31 ", "2020-01-31"), ("", None), (None, None), ("미정", "미정")])
def test_date_text(spark, text, want):
    assert one(spark, text, N.date_text) == want


def relations_of(spark, roots):
    rows = [("은행", r, f"{r}하다", "보고서", f"은행은 보고서를 {r}한다", i) for i, r in enumerate(roots)]
    return spark.createDataFrame(rows, "agent string, verb_root string, verb_lemma string, patient string, evidence_text string, n int")


def routed(spark, roots):
    root_map = spark.createDataFrame([("제출", "SUBMITS", [], False), ("처분", "DISPOSES", ["SANCTIONS"], True)], "verb_root string, mapped string, alternatives array<string>, needs_context boolean")
    buckets = spark.createDataFrame([("하다", "AMBIGUOUS"), ("이하", "DEF")], "verb_root string, bucket string")
    return routing.route(relations_of(spark, roots), root_map, buckets)


ROOTS = ["제출", "처분", "하다", "이하", "낯선"]


def by_root(rows):
    return {r.verb_root: (r.edge_type, r.extraction_method, r.counters) for r in rows.collect()}


def test_an_answering_classifier(spark):
    """Verdicts of a type, of none and of what isn't a candidate; a fallback counts twice."""
    rows = routed(spark, ROOTS)
    got = by_root(routing.resolve(rows, lambda texts, options: ["SANCTIONS" if "처분" in t else "REVIEWS" if "낯선" in t else routing.NONE for t in texts]))
    assert got == {
        "제출": ("SUBMITS", "rule", ["rule"]), "처분": ("SANCTIONS", "llm_disambiguation", ["llm_disambiguation"]), "하다": (None, None, ["skipped_llm_none"]),
        "이하": (None, None, ["skipped_non_action_root"]), "낯선": ("REVIEWS", "llm_disambiguation", ["llm_disambiguation_unmapped_root"]),
    }
    none = by_root(routing.resolve(rows, lambda texts, options: [routing.NONE] * len(texts)))
    assert none["처분"] == ("DISPOSES", "rule", ["rule", "llm_disambiguation_fallback"]) and none["낯선"] == (None, None, ["skipped_llm_none"])


@pytest.mark.parametrize("fails", [lambda t, o: [None] * len(t), lambda t, o: 1 / 0, lambda t, o: ["SUBMITS"], lambda t, o: ["?"] * len(t)])
def test_a_failing_classifier(spark, fails):
    got = by_root(routing.resolve(routed(spark, ROOTS).repartition(1), fails))
    assert got["처분"] == ("DISPOSES", "rule", ["rule", "llm_disambiguation_fallback"])
    assert got["하다"] == got["낯선"] == (None, None, ["skipped_llm_disambiguation_failed"])


def test_counters(spark):
    rows = routed(spark, ROOTS)
    found = routing.resolve(rows)
    got = {r.counter: r.n for r in routing.build_counters(rows, found, rows.select("agent").distinct()).collect()}
    assert got == {"raw_svo_records_with_both_endpoints": 5, "relations_total": 2, "entities_total": 1, "rule": 2, "llm_disambiguation_fallback": 1, "skipped_non_action_root": 1, "skipped_llm_disambiguation_failed": 2}


def test_types_by_model(spark):
    names = spark.createDataFrame([("금융위",), ("모르는 것",), ("아무개",), ("실패",), (None,)], "name string")
    typer = lambda some: [("Person", "임원") if n == "아무개" else ("Thing", "x") if n == "모르는 것" else None for n in some]
    got = {r.name: (r.label, r.subtype, r.method) for r in routing.type_mentions(names, typer=typer).collect()}
    default = ("Concept", None, "llm_fallback_default")
    assert got == {"금융위": ("Organization", "위원회", "dict"), "모르는 것": default, "아무개": ("Person", "임원", "llm"), "실패": default, None: default}
    assert {r.method for r in routing.type_mentions(names, typer=lambda some: 1 / 0).collect()} == {"dict", "llm_fallback_default"}


def test_tokenizer_runs_in_workers(spark):
    rows = spark.createDataFrame([("은행 이",), (None,)], "unit_text string")
    got = clauses.tokenize(rows, lambda: lambda text: [(w, "NNG") for w in text.split()]).collect()
    assert [[tuple(t) for t in r.tokens] for r in got] == [[("은행", "NNG"), ("이", "NNG")], []]


def test_reload(spark):
    e = spark.createDataFrame([("1", "Person", "가", "", "임원", None, None), ("2", "Concept", "나", None, None, "", "")], "id string, label string, name string, category string, role_hint string, doc_type string, concept_type string")
    r = spark.createDataFrame([("a", "HOLDS", "1", "2", "은행법", [3, 4], 1, "의무", "능동"), ("b", "HOLDS", "2", "1", "은행법", [], None, "없음", "능동"), ("c", "HOLDS", "1", "9", "은행법", None, None, "없음", "능동")], "id string, edge_type string, source_entity_id string, target_entity_id string, source_law string, article_no array<int>, paragraph_no int, modality string, voice string")
    vertices, edges, entity_docs, relation_docs = build.reload(e, r)
    assert {(v.id, v.subtype) for v in vertices.collect()} == {("1", "임원"), ("2", None)}
    assert {(x.id, x.src, x.dst, x.article_no) for x in edges.collect()} == {("a", "1", "2", 3), ("b", "2", "1", None)}
    assert {d.description for d in entity_docs.collect()} == {"가 (Person: 임원)", "나 (Concept)"} and relation_docs.count() == 2


def test_upserts_are_idempotent(spark):
    old = spark.createDataFrame([("1", "p", "en", "a")], "id string, file_path string, lang string, raw_text string")
    new = spark.createDataFrame([("p", "fr", "b"), ("q", "de", "c")], "file_path string, lang string, raw_text string")
    once = upserts.upsert_documents(old, new)
    assert {(r.file_path, r.lang, r.raw_text) for r in once.collect()} == {("p", "en", "b"), ("q", "de", "c")}
    assert sorted(map(str, once.collect())) == sorted(map(str, upserts.upsert_documents(once, new).collect()))


def test_merging(spark):
    e = spark.createDataFrame([("1", "O", "금융위"), ("2", "O", "금융위원회"), ("3", "O", "경우감사원"), ("4", "O", "등감사원"), ("5", "P", "금융위")], "id string, label string, name string")
    m = upserts.merge_map(e)
    assert {(r.id, r.target, r.action) for r in m.collect()} == {("1", "2", "merge"), ("3", "3", "rename"), ("4", "3", "merge"), ("5", "5", "rename")}
    rel = spark.createDataFrame([("1", "4")], "src string, dst string")
    assert [tuple(r) for r in upserts.repoint(rel, m, "src", "dst").collect()] == [("2", "3")]
    assert {r.action: r.n for r in upserts.merge_report(m, rel, "src", "dst").collect()} == {"merge": 2, "rename": 2, "repointed": 2}


def test_sources(spark, tmp_path):
    (tmp_path / "laws.txt").write_text("1\t은행법\n\n2\t없는 법\n")
    laws = readers.law_list(spark, str(tmp_path / "laws.txt"))
    (tmp_path / "md" / "은행법").mkdir(parents=True)
    (tmp_path / "md" / "은행법" / "a.md").write_text(TEXT)
    files = readers.markdown(spark, str(tmp_path / "md"))
    assert files.select(readers.front_matter(F.col("raw_text"))["title"]).first()[0] == "은행법"
    index = readers.directory_index(files)
    assert [tuple(r) for r in index.collect()] == [("은행법", "은행법")]
    got = {r.name: r.directory for r in readers.match_laws(laws, index, {"없는 법": "아무"}).collect()}
    assert got == {"은행법": "은행법", "없는 법": None}
    sinks.by_bucket(spark.createDataFrame([("REF", "a"), ("DEF", "b")], "bucket string, root string"), str(tmp_path / "out"))
    assert {r.root for r in readers.root_groups(spark, str(tmp_path / "out" / "bucket=REF")).collect()} == {"a"}


def test_answer_and_build(spark):
    text = "##### 제1조 (목적)\n은행은 보고서를 제출하여야 한다.\n"
    docs = spark.createDataFrame([("a.md", "은행법", text)], "file_path string, source_law string, raw_text string")
    tokens = F.array(*(F.struct(F.lit(f).alias("form"), F.lit(t).alias("tag")) for f, t in toks(CASES["topic"])))
    roots = spark.createDataFrame([("제출", "SUBMITS", [], False)], "verb_root string, mapped string, alternatives array<string>, needs_context boolean")
    buckets = spark.createDataFrame([], "verb_root string, bucket string")
    s = build.build(docs, lambda u: u.withColumn("tokens", tokens), roots, buckets)
    edge = s.edges.collect()
    assert [(r.edge_type, r.article_no, r.modality) for r in edge] == [("SUBMITS", 1, "의무")]
    kept = [spark.createDataFrame(x.collect(), x.schema) for x in (s.entity_docs.select("id", "name", "label", "embedding"), s.relation_docs, s.vertices, s.edges)]
    got = answer.answer_question(spark, "보고서 제출", *kept, top_k=2)
    assert got.edge_type_source == "keyword" and len(got.context) == 2 and not got.context_truncated
    assert answer.answer_question(spark, "아무 말", *kept[:3], kept[3].limit(0)).answer == answer.NOTHING


@pytest.mark.parametrize("how", [{"top_k": 0}, {"top_k": 21}, {"depth": 0}, {"depth": 4}, {"question": ""}])
def test_bounds_of_a_question(spark, how):
    none = spark.range(0)
    with pytest.raises(ValueError, match="needed"):
        answer.answer_question(spark, how.pop("question", "물음"), none, none, none, none, **how)


def test_nearest(spark):
    docs = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0]), (4, None)], "id int, embedding array<float>")
    assert [r.id for r in vectors.nearest(docs, [1.0, 0.1], 5).collect()] == [1, 2]


def test_entities_are_merged_without_being_dealt_by_what_they_resolve_to(spark):
    """All variants of a name resolve to one of a few, which would be one task's work."""
    names = [*vocab.ALIASES, *vocab.CANONICAL, *(j + c for j in vocab.JUNK_PREFIXES for c in vocab.CANONICAL)]
    resolved = dict(spark.createDataFrame([(n,) for n in names], "name string").select("name", N.resolve_alias(F.col("name"))).collect())
    assert all(resolved.get(r, r) == r for r in resolved.values())  # what a name resolves to stays
    rng = random.Random(5)
    rows = [(i, rng.choice(["Organization", "Person", None]), rng.choice([*names[:6], names[-1], "이름", None])) for i in range(300)]
    e = spark.createDataFrame(rows, "id long, label string, name string")
    firsts = lambda key: {k: min(i for i, la, n in rows if la and n and key(la, n) == k) for k in {key(la, n) for _, la, n in rows if la and n} if k}
    known, variants = firsts(lambda la, n: (la, n)), firsts(lambda la, n: (la, resolved[n]) if resolved.get(n, n) != n else None)
    want = sorted((i, la, n, resolved[n], known.get((la, resolved[n]), variants[la, resolved[n]])) for i, la, n in rows if la and n and resolved.get(n, n) != n)
    found = upserts.merge_map(e)
    assert sorted(tuple(r)[:5] for r in found.collect()) == want
    assert all(r.action == ("rename" if r.target == r.id else "merge") for r in found.collect())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = upserts.merge_map(e)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert not any("Filter" in x and "element_at" in x for x in plan.split("\n")), plan  # names are resolved once each
