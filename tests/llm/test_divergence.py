"""The audit against exact integers in plain Python, with odd rows, many sources, and its parts."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexmesh.llm import common, divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = ["n", "h1", "h2", "term", "p", "q", "slot", "base", "value", "doc_id"]


def plain(rows, least=10):
    """The contract over dicts: every pair and term by itself."""
    rows = [tuple(x or "" for x in r) for r in rows]
    out = set()
    for lang in {r[0] for r in rows}:
        mine = [(s, TERM.findall(t.translate(LOW))) for m, s, t in rows if m == lang]
        docs = Counter(t for _, words in mine for t in set(words))
        kept = sorted(t for t, n in docs.items() if n >= least)
        groups = {s: Counter() for s, _ in mine}
        whole = Counter()
        for s, words in mine:
            few = [w for w in words if docs[w] >= least]
            groups[s].update(few)
            whole.update(few)

        def share(c, kept=kept):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        f = lambda p, q: (p - q) ** 2 // (p + q)
        p, q = {s: share(c) for s, c in groups.items()}, share(whole)
        for s in groups:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in groups if o != s)
            terms = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if groups[s][t] and p[s][t] > q[t])[:10]
            for part, found in (("pair", pairs), ("term", terms)):
                out |= {(lang, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(found)}
    return out


def corpus(seed, sources, n):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefgé" for b in "hijkß"] + ["Über", "THE"]
    rows = []
    for _ in range(n):
        s = rng.choice(sources)
        near = random.Random(hash(s) if s is None else sum(s.encode())).sample(words, 12)
        rows.append((rng.choice(["en", "en", "de"]), s, " ".join(rng.choices(near + words[:6], k=rng.randint(0, 25)))))
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, "lang string, source string, text string").withColumns({c: F.lit(3) for c in ODD}).repartition(3)


def same(spark, rows, **how):
    got = divergence.audit(table(spark, rows), **how).collect()
    assert len({tuple(r)[:4] for r in got}) == len(got)
    assert {tuple(r) for r in got} == plain(rows, **how)


def test_audit_against_plain(spark):
    rows = corpus(1, ["a", "b", "c", "Z", "é", "", None], 300)
    rows += [("en", "a", rows[0][2])] * 40 + [("en", "b", rows[0][2])] * 3 + [("de", "a", rows[0][2])] * 5  # copies within and across groups
    rows += [(None, None, None), (None, "a", "x y"), ("en", "lone", None), ("fr", "one", "a b c"), ("fr", "two", ""), ("it", "only", "sì")]
    rows += [("en", "long", "ah " * 40_000 + "q" * 100_000), ("en", "a", "42 -- __ !")]
    same(spark, rows)


def test_more_sources_than_a_matrix_has(spark, monkeypatch):
    monkeypatch.setattr(divergence, "WIDTH", 4)
    monkeypatch.setattr(divergence, "LISTED", 3)
    monkeypatch.setattr(divergence, "HELD", 50)
    rows = corpus(2, [f"s{i}" for i in range(19)], 200)
    rows += [(m, f"s{i % 19}", rows[3][2]) for i in range(60) for m in ("en", "de")]
    same(spark, rows, least=4)


def test_collapsed_texts(spark):
    """Each text of a language that stands twice is taken once, its sources with how often they have it."""
    rows = [("en", "a", "x y")] * 3 + [("en", "b", "x y"), ("de", "a", "x y"), ("en", "a", "x"), ("en", "a", "")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").withColumn("h1", F.xxhash64("lang", "text"))
    twice = spark.sparkContext.broadcast(common.held_twice(docs.select("h1")))
    got = divergence.repeated(docs, twice, 1).collect()
    assert [(r["lang"], r["text"], sorted(tuple(s) for s in r["sources"])) for r in got] == [("en", "x y", [("a", 3), ("b", 1)])]
    terms = divergence.collapsed(docs.drop("h1"), 1).groupBy("lang", "source", "term").agg(F.sum("count"), F.sum("docs")).collect()
    assert sorted(map(tuple, terms)) == [("de", "a", "x", 1, 1), ("de", "a", "y", 1, 1), ("en", "a", "x", 4, 4), ("en", "a", "y", 3, 3), ("en", "b", "x", 1, 1), ("en", "b", "y", 1, 1)]


@pytest.mark.parametrize("n, v, c", [(0, 1, 0), (7, 3, 5), (10**13, 10**8, 10**13), (3 * 10**14, 10**9, 1), (10**12, 7, 999_999_999_999)])
def test_shares_are_exact(spark, n, v, c):
    got = spark.createDataFrame([(n, v, c)], "n long, v long, c long").select(divergence._share("c")).first()[0]
    assert got == 1 + 10**9 * (c + 2) // (n + 2 * v)


def test_empty(spark):
    got = divergence.audit(table(spark, []))
    assert got.count() == 0 and got.columns == ["lang", "source", "part", "item", "value", "rank"]
