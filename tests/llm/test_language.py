"""Rank-order profiles against a plain version in Python, held-out accuracy, and odd tables."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F

from lexmesh.llm import language

ODD = ["n", "gram", "rank", "held_out", "score", "word"]


def plain_counts(text):
    out = Counter()
    for w in regex.findall(r"\p{L}[\p{L}\p{M}]*", (text or "").lower()):
        p = f"_{w}_"
        out.update(p[i : i + n] for n in range(1, 6) for i in range(len(p) - n + 1) if p[i : i + n] != "_")
    return out


def plain(docs):
    """{row: (held_out, lang_pred, score)} by the definition, over lists and dicts."""
    held = [d is None or zlib.crc32(str(d).encode()) % 5 == 0 for d, _, _ in docs]
    total = {}
    for (_, text, lang), h in zip(docs, held, strict=True):
        if not h and lang is not None and plain_counts(text):
            total.setdefault(lang, Counter()).update(plain_counts(text))
    signed = lambda g: int(np.array([language.gram_hash(g)], np.uint64).view(np.int64)[0])
    profile = {m: {g: i for i, (g, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], signed(x[0])))[:400])} for m, c in total.items()}
    out = []
    for (_, text, _), h in zip(docs, held, strict=True):
        c = plain_counts(text)
        if not c or not profile:
            out.append((h, "und", 0.0))
            continue
        top = sorted(c.items(), key=lambda x: (-x[1], language.gram_hash(x[0])))[:400]
        places = {}
        for i, (_, n) in enumerate(top):
            places.setdefault(n, []).append(i)
        middle = {n: sum(at) / len(at) for n, at in places.items()}
        far = {m: sum(abs(middle[n] - p[g]) if g in p else 400 for g, n in top) for m, p in profile.items()}
        best = min(far, key=lambda m: (far[m], m))
        out.append((h, best, 1 - far[best] / (400 * len(top))))
    return out


def table(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns({c: F.lit(1) for c in ODD}).repartition(3)


def same(spark, docs):
    got = language.identify(table(spark, docs)).collect()
    assert len(got) == len(docs)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    a = sorted(((r["doc_id"], r["held_out"], r["lang_pred"], round(r["score"], 9)) for r in got), key=key)
    b = sorted(((d[0], h, m, round(s, 9)) for d, (h, m, s) in zip(docs, plain(docs), strict=True)), key=key)
    assert a == b
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_against_plain(spark):
    rng = random.Random(5)
    kinds = {"en": ["the", "and", "of", "Hearing", "thing"], "de": ["der", "und", "Übung", "ung", "größe"], "ко": ["법률", "회사는", "제출"], "": ["ñu", "el", "los"]}
    docs = []
    for i in range(120):
        lang = rng.choice(list(kinds))
        docs.append((i, " ".join(rng.choices(kinds[lang] + ["x1", "42", "a-b"], k=rng.choice([1, 2, 5, 40, 300]))), lang))
    letters = "abcdefghijklmnopqrstuvwxyz"
    docs += [(500 + i, " ".join("".join(rng.choices(letters, k=9)) for _ in range(200)), rng.choice(["en", None])) for i in range(20)]  # over 400 n-grams, many ties
    docs += [(None, "the and of", "en"), (7, "the the", "de"), (7, "the the", "de"), (600, None, "en"), (601, "", "en"), (602, "12 ²½ -- _", "de"), (603, "the", None)]
    docs += [(604, "Ab̀ é" * 3, "en"), (605, "x" * 5000, "xx"), (606, "İI ΑΣ ΑΣ.", "el")]
    same(spark, docs)


def ngrams(texts):
    return {i: dict(zip(h.tolist(), n.tolist(), strict=True)) for i, h, n in language.count_ngrams(pa.array(texts, pa.string()))}


def test_ngrams_against_plain(monkeypatch):
    """Also where texts are taken together or cut at gaps."""
    rng = random.Random(6)
    texts = [None, "", "1", "a", "\u0300a", "a\u0300\u0300b c", "ab", "Hello, World!", "Straße ÉTÉ 법률은", "x" * 700, "\U0001d400b \U00020000"]
    texts += [" ".join("".join(rng.choices("abcÉ\u03001-", k=rng.randint(1, 30))) for _ in range(rng.randint(1, 200))) for _ in range(20)]
    want = {i: {language.gram_hash(g): n for g, n in plain_counts(t).items()} for i, t in enumerate(texts)}
    assert ngrams(texts) == want
    monkeypatch.setattr(language, "CHUNK", 100)
    assert ngrams(texts) == want


def test_task_sums_are_passed_on(spark, monkeypatch):
    """Profiles are the same when tasks pass their counts on early."""
    docs = [(i, f"word{chr(97 + i % 26)} and other{chr(97 + i % 7)} words", "en" if i % 3 else "de") for i in range(100)]
    want = sorted(map(tuple, language.profiles(table(spark, docs)).collect()))
    monkeypatch.setattr(language, "HELD", 20)
    assert sorted(map(tuple, language.profiles(table(spark, docs)).collect())) == want


def test_nothing_learned(spark):
    same(spark, [(0, "the and", None), (1, None, "en"), (2, "12", "en")])
    got = language.identify(table(spark, []))
    assert got.count() == 0 and got.columns == ["doc_id", "held_out", "lang_pred", "score"]


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 2)
    docs = [(i, "word", f"l{i % 4}") for i in range(40)]
    try:
        language.identify(table(spark, docs))
    except ValueError as e:
        assert "4 values of lang" in str(e)
    else:
        raise AssertionError("not refused")


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null and lang_pred <> 'und'")
    right, n = got.agg(F.sum(F.expr("CAST(lang = lang_pred AS INT)")), F.count("*")).first()
    assert n > 20 and right >= 0.95 * n
