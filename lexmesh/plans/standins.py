"""The engine's inputs as views of star-schema tables: vertices and edges, vectors, statutes, mentions and tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tagged tokens that units are made of, in a cycle.
TOKENS = [
    ("금융위원회", "NNG"), ("는", "JX"), ("감사", "NNG"), ("위원", "NNG"), ("을", "JKO"), ("선임", "NNG"), ("하", "XSV"), ("ㄹ", "ETM"),
    ("수", "NNB"), ("있", "VA"), ("다", "EF"), (".", "SF"), ("회사", "NNG"), ("등", "NNB"), ("이", "JKS"), ("보고서", "NNG"),
    ("를", "JKO"), ("제출", "NNG"), ("하", "XSV"), ("어야", "EC"), ("하", "VX"), ("ㄴ다", "EF"), ("법원", "NNP"), ("에", "JKB"),
    ("의하", "VV"), ("어", "EC"), ("해임", "NNG"), ("되", "XSV"), ("지", "EC"), ("아니하", "VX"), ("ㄴ다", "EF"),
]
LAWS = ["은행법", "보험업법", "자본시장법"]
MODALITIES, VOICES = ["의무", "금지", "재량", "없음"], ["능동", "피동"]
#: Names are made of a filler or nothing, a stem and an ending.
FILLERS = ["", "경우", "등", "기간동안", "아무"]
STEMS = ["금융위원회", "금융감독원", "한국은행", "금융위", "은행 법", "감사원·장", "내부통제", "불법", "보험회사", "대표이사", "시행령", "이름"]
ENDINGS = ["", "", "", "", "장", " 직원", "제도", "법"]
WORDS = ["임명", "보고", "금지", "취득", "감독", "없음", "소집", "제한"]


def pick(values: list[str], by: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), F.pmod(by, F.lit(len(values))).cast("int"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, label, name)."""
    kinds = [("customer", "c", "c_custkey", "c_name", "Person"), ("supplier", "s", "s_suppkey", "s_name", "Organization"), ("part", "p", "p_partkey", "p_name", "Concept"), ("nation", "n", "n_nationkey", "n_name", "Organization"), ("region", "r", "r_regionkey", "r_name", "Organization"), ("orders", "o", "o_orderkey", None, "LegalDocument")]
    out = None
    for name, prefix, key, title, label in kinds:
        ident = F.concat(F.lit(prefix), F.col(key).cast("string"))
        rows = table(spark, sf_dir, name).select(ident.alias("id"), F.lit(label).alias("label"), (F.col(title) if title else F.concat(F.lit("Order#"), F.col(key).cast("string"))).alias("name"))
        out = rows if out is None else out.unionByName(rows)
    return out


def edges(spark: SparkSession, sf_dir: str, facts: bool = True) -> DataFrame:
    """(id, edge_type, src, dst) and, with facts, source_law, article_no, paragraph_no, modality, voice."""
    t = lambda name: table(spark, sf_dir, name)
    node = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    days = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date"))
    line = F.concat_ws("_", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.round(F.col("l_extendedprice") * 100).cast("long"), days)
    make = lambda rows, ident, kind, src, dst, n: rows.select(ident.alias("id"), F.lit(kind).alias("edge_type"), src.alias("src"), dst.alias("dst"), n.cast("long").alias("n"))
    parts = [
        make(t("customer"), node("in_c", "c_custkey"), "IN_NATION", node("c", "c_custkey"), node("n", "c_nationkey"), F.col("c_custkey")),
        make(t("supplier"), node("in_s", "s_suppkey"), "IN_NATION", node("s", "s_suppkey"), node("n", "s_nationkey"), F.col("s_suppkey")),
        make(t("nation"), node("in_n", "n_nationkey"), "IN_REGION", node("n", "n_nationkey"), node("r", "n_regionkey"), F.col("n_nationkey")),
        make(t("orders"), node("by_o", "o_orderkey"), "PLACED_BY", node("o", "o_orderkey"), node("c", "o_custkey"), F.col("o_orderkey")),
    ]
    edge = lambda prefix, kind, src, dst, n: F.struct(F.concat(F.lit(prefix), line).alias("id"), F.lit(kind).alias("edge_type"), src.alias("src"), dst.alias("dst"), F.col(n).cast("long").alias("n"))
    # both edges of a line come from one scan
    out = t("lineitem").select(F.inline(F.array(edge("co_", "CONTAINS", node("o", "l_orderkey"), node("p", "l_partkey"), "l_partkey"), edge("su_", "SUPPLIED_BY", node("p", "l_partkey"), node("s", "l_suppkey"), "l_suppkey"))))
    for x in parts:
        out = out.unionByName(x)
    n = F.col("n")
    law = {"source_law": pick(LAWS, n), "article_no": (1 + F.pmod(n, F.lit(50))).cast("int"), "paragraph_no": F.when(F.pmod(n, F.lit(4)) != 0, F.pmod(n, F.lit(4)).cast("int")), "modality": pick(MODALITIES, n), "voice": pick(VOICES, n)}
    return (out.withColumns(law) if facts else out).drop("n")


def seed_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, words): all words of each whole text, letters only."""
    found = F.filter(F.split(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]+", " "), " "), lambda w: w != "")
    return table(spark, sf_dir, "documents").select("doc_id", "source", "lang", found.alias("words"))


#: How far apart the ids of mentions of neighbouring documents are.
MENTIONS = 1_000_000


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, name): a mention for every word of the documents, made of a filler, a stem and, one in three, the word itself."""
    rows = words(spark, sf_dir).select("doc_id", F.posexplode("words").alias("pos", "w"))
    n = F.length("w") + 7 * F.ascii("w")
    name = F.concat(pick(FILLERS, F.col("pos")), pick(STEMS, n), F.when(n % 3 == 0, F.lower("w")).otherwise(""), pick(ENDINGS, F.ascii("w") + F.col("pos")))
    return rows.select((F.col("doc_id") * MENTIONS + F.col("pos")).alias("id"), name.alias("name"))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, question): a conversation's turn with two words of the domain before it."""
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", F.concat(pick(WORDS, F.col("conv_id")), F.lit(" "), pick(WORDS, F.col("conv_id") + 3 * F.col("turn")), F.lit(" "), F.coalesce("text", F.lit(""))).alias("question"))


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(article, unit_ord, tokens): four documents are the units of an article, and every word is a token."""
    d = F.col("doc_id")
    cycle = F.array(*(F.struct(F.lit(f).alias("form"), F.lit(t).alias("tag")) for f, t in TOKENS))
    at = lambda w: F.pmod(7 * F.length(w) + F.ascii(w) + 3 * F.ascii(F.right(w, F.lit(1))), F.lit(len(TOKENS)))
    return words(spark, sf_dir).select(F.floor(d / 4).alias("article"), F.pmod(d, F.lit(4)).cast("int").alias("unit_ord"), F.transform("words", lambda w: F.get(cycle, at(w))).alias("tokens"))


#: Parts that a document's words are dealt to, in order.
PARTS = 5


def statutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, raw_text): Markdown with two articles and addenda, whose units hold all words of a document."""
    d, w = F.col("doc_id"), F.col("words")
    edge = lambda k: F.floor(F.size(w) * k / PARTS).cast("int")
    part = lambda k: F.array_join(F.slice(w, edge(k) + 1, edge(k + 1) - edge(k)), " ")
    n = lambda c: c.cast("string")
    text = F.concat(
        F.lit("---\ntitle: "), F.col("source"), F.lit("\nlang: "), F.col("lang"), F.lit("\n---\n# 제1장\n##### 제"), n(1 + F.pmod(d, F.lit(9))), F.lit("조 (목적)\n"), part(0), F.lit(" 정한다. <개정 2009.1.30>\n### 제2절\n##### 제"),
        n(2 + F.pmod(d, F.lit(9))), F.lit("조의"), n(2 + F.pmod(d, F.lit(3))), F.lit(" (정의)\n**①** 가 "), part(1), F.lit("\n  1\\. 나 "), part(2), F.lit("\n    가\\. 다 "), part(3), F.lit("\n**㉑** 라 "), part(4), F.lit("\n## 부칙 끝\n##### 제1조 (시행일)\n마\n"),
    )
    return words(spark, sf_dir).select("doc_id", text.alias("raw_text"))
