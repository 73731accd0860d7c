"""Sources as they come: front matter, tagged values, aliases, manifests."""

import random

import pytest
from pyspark.sql import functions as F

from lexmesh.functions import names as N
from lexmesh.functions import vocab
from lexmesh.operators import routing, structure
from lexmesh.sources import readers, sinks


@pytest.mark.parametrize(("block", "want"), [
    ("a: 1\na: 2", {"a": ["2"]}),
    ("a: [x, 'y, z', \"q\\\"r\"] # c\nb:", {"a": ["x", "y, z", 'q"r'], "b": []}),
    ("a:\n- x\n- 'y'\nb:\n  - z # c\n  -\nc: d", {"a": ["x", "y"], "b": ["z"], "c": ["d"]}),
    ("a: 'it''s # not a comment' # one\nb: x#y # z\n# c: d\n\nd: http://e: f", {"a": ["it's # not a comment"], "b": ["x#y"], "d": ["http://e: f"]}),
    ("a: ~\nb: null\nc: \"\"\n'k: v': w", {"a": [], "b": [], "c": [""], "k: v": ["w"]}),
    ("a: |\n  one\n  two\nb: >\n  three\n  four\nc: 2020-01-31", {"a": ["one\ntwo"], "b": ["three four"], "c": ["2020-01-31"]}),
    ("no colon\n- stray", {}), ("a: []\nb: [x, ]", {"a": [], "b": ["x"]}),
])
def test_front_matter_blocks(block, want):
    assert readers.parse_block(block) == want


def test_front_matter_of_texts(spark):
    texts = ["---\na: 1\n---\nrest: 2", "---\na: 1\nno end", "x\n---\na: 1\n---\n", "", None, "---\n---\n"]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", readers.front_lists(F.col("t")).alias("m"), readers.front_matter(F.col("t")).alias("s")).collect()
    assert {r.i: r.m for r in got} == {0: {"a": ["1"]}, 1: {}, 2: {}, 3: {}, 4: {}, 5: {}}
    assert {r.i: r.s for r in got}[0] == {"a": "1"}


@pytest.mark.parametrize(("text", "want"), [
    ('{"id": 1, "label": "a::vertex b"}::vertex', ("vertex", '{"id": 1, "label": "a::vertex b", "_agtype": "vertex"}', None)),
    ("[{}::edge, {\"a\": {\"b\": [1]}}::vertex]::path", ("path", '[{"_agtype": "edge"}, {"a": {"b": [1]}, "_agtype": "vertex"}]', None)),
    ('[{"a": "\\\\\\"}::edge"}::edge, 3]', (None, '[{"a": "\\\\\\"}::edge", "_agtype": "edge"}, 3]', None)),
    ("3::numeric", ("numeric", "3", None)), ("true", (None, "true", None)), ('"x"', (None, '"x"', None)), ("null", (None, "null", None)),
    ("{broken::vertex", (None, None, "{broken::vertex")), ("", (None, None, "")), (None, (None, None, None)),
])
def test_tagged_values(spark, text, want):
    assert readers.untag(text) == want
    got = spark.createDataFrame([(text,)], "x string").select(readers.parsed_value(F.col("x")).alias("v")).first().v
    assert tuple(got) == want


def test_untagged_rows(spark):
    rows = spark.createDataFrame([('[{"id": 1, "label": "a::vertex b"}::vertex]::path',), ("nothing",)], "x string")
    got = [r.v for r in rows.select(readers.untagged(F.col("x"), "array<struct<id: long, label: string, _agtype: string>>").alias("v")).collect()]
    assert [tuple(x) for x in got[0]] == [(1, "a::vertex b", "vertex")] and got[1] is None


def test_aliases_of_normalised_names(spark):
    index = spark.createDataFrame([("은행법시행령", "은행법 시행령"), ("보험업법", "보험업법")], "key string, directory string")
    laws = spark.createDataFrame([(1, "첫 째"), (2, "첫째"), (3, "은행법 시행령"), (4, " 은행법시행령 "), (5, "없는 법"), (6, None)], "no int, name string")
    got = {r.no: (r.directory, r.alias_applied) for r in readers.match_laws(laws, index, {"첫째": "은행법시행령"}).collect()}
    target = "은행법 시행령"
    assert got == {1: (target, True), 2: (target, True), 3: (target, False), 4: (target, True), 5: (None, False), 6: (None, False)}


def test_manifest_and_copy(spark, tmp_path):
    text = "---\n법령MST: 7\n공포일자: 2020-01-31\n소관부처: [가, 나]\n---\n본문"
    files = spark.createDataFrame([("/kr/은행법/b.md", text), ("/kr/은행법/a.md", "x"), ("/kr/other/c.md", "y")], "file_path string, raw_text string")
    laws = spark.createDataFrame([(2, "은행법"), (1, "없는 법")], "no int, name string")
    matched = readers.match_laws(laws, readers.directory_index(files), {})
    sinks.manifest(readers.law_files(matched, files), str(tmp_path / "m"))
    got = readers.manifest_documents(readers.manifest_laws(spark, str(tmp_path / "m"))).orderBy("file_path").collect()
    assert [(r.no, r.law_mst, r.promulgation_date, r.competent_ministry, r.file_path) for r in got] == [(2, None, None, None, "은행법/a.md"), (2, "7", "2020-01-31", "가, 나", "은행법/b.md")]
    assert [tuple(r) for r in spark.read.json(str(tmp_path / "m" / "missing")).collect()] == [(1, "없는 법")]
    sinks.copy_files(files, matched, str(tmp_path / "c"))
    assert sorted((r.directory, r.file, r.raw_text) for r in spark.read.parquet(str(tmp_path / "c")).collect()) == [("은행법", "a.md", "x"), ("은행법", "b.md", text)]


def test_copies_of_many_laws_are_few_files_in_order(spark, tmp_path):
    """Files don't grow in number with the laws, and a folder's name stays a text."""
    files = spark.range(600).select(F.explode(F.array(F.lit("b"), F.lit("a"))).alias("f"), F.format_string("%04d", "id").alias("d")).select(F.concat(F.lit("/kr/"), "d", F.lit("/"), "f", F.lit(".md")).alias("file_path"), F.col("d").alias("raw_text"))
    sinks.copy_files(files, spark.range(0, 600, 2).select(F.format_string("%04d", "id").alias("directory")), str(tmp_path / "c"))
    parts = sorted((tmp_path / "c").rglob("*.parquet"))
    assert len(parts) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = [tuple(r) for p in parts for r in spark.read.parquet(str(p)).collect()]
    assert got == [(f"{i:04d}", f"{f}.md", f"{i:04d}") for i in range(0, 600, 2) for f in "ab"]


RULES = [("Person", s) for s in vocab.PERSON_SUFFIXES] + [("Organization", s) for s in vocab.ORG_SUFFIXES] + [("Concept", s) for s in vocab.CONCEPT_SUFFIXES]


def by_scanning(name):
    if name not in vocab.NOT_LAWS and any(name.endswith(s) and len(name) > len(s) for s in vocab.LAW_SUFFIXES):
        return "LegalDocument", "법령"
    return next((r for r in RULES if name.endswith(r[1])), (None, None))


def test_suffix_index_equals_the_rules_in_order(spark):
    suffixes = [s for _, s in RULES] + vocab.LAW_SUFFIXES
    names = sorted({a + b for a in ("", "가", "대표", "은행 ") for b in suffixes} | {a + b for a in suffixes for b in suffixes[::7]} | set(vocab.NOT_LAWS) | {"", "x"})
    rows = spark.createDataFrame([(n,) for n in names], "name string").withColumn("t", N.entity_type(F.col("name"))).collect()
    assert {r.name: (r.t.label, r.t.subtype) if r.t else (None, None) for r in rows} == {n: by_scanning(n) for n in names}


def test_clashing_columns_and_distinct_names(spark):
    asked = []

    def typer(names):
        asked.extend(names)
        return [("Person", "x") for _ in names]

    rows = spark.createDataFrame([("a", 1, 2, 3, "old"), ("a", 1, 2, 3, "old"), ("국세청", 1, 2, 3, "old"), (None, 1, 2, 3, "old")], "name string, kind int, Resolved int, answer int, label string")
    got = routing.type_mentions(rows, typer=lambda names: [("Person", str(len(names))) for _ in names])
    assert got.columns == ["name", "kind", "Resolved", "answer", "label", "subtype", "method"]
    assert sorted((r.name or "", r.label, r.subtype) for r in got.collect()) == [("", "Concept", None), ("a", "Person", "1"), ("a", "Person", "1"), ("국세청", "Organization", "청")]


def test_articles_of_files_larger_than_a_split(spark, tmp_path):
    """Pieces that several tasks read make the same articles as whole texts."""
    rng = random.Random(4)
    lines = ["##### 제{}조 (가나)", "##### 제{}조의2 (다)", "##### 제{}조", "###### 깊이", "# 제1장", "#### 절", "본문 {} <개정 2009.1.30>", "**①** 항 {}", "  1\\. 호", "", "말 " * 30]
    for k in range(6):
        text = "\n".join(rng.choice(lines).format(rng.randint(1, 99)) for _ in range(150))
        text = {0: "##### 제1조 (처음)\n" + text, 1: "---\na: 1\n---\n" + text, 2: text[:2000] + "\n## 부칙 <2020>\n" + text, 3: "## 부칙\n" + text, 4: "", 5: text}[k]
        (tmp_path / f"law{k}").mkdir()
        (tmp_path / f"law{k}" / "a.md").write_text(text)
    whole = structure.articles(readers.markdown(spark, str(tmp_path))).drop("raw_text")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        pieces = readers.markdown_pieces(spark, str(tmp_path))
        assert pieces.select("file_path", "at.split").distinct().count() > 20
        got = sorted(map(tuple, structure.articles_of_pieces(pieces).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = sorted(map(tuple, whole.collect()), key=str)
    assert len(want) > 60 and got == want
