"""The similarity join where rows share an id: one component per document."""

import random

from pyspark.sql import functions as F

from lexmesh.llm import jaccard


def shingles(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i : i + 3]) for i in range(len(w) - 2)) if len(w) >= 3 else frozenset([tuple(w)]) if w else frozenset()


def components(rows):
    """{doc_id: smallest id reachable}: documents link when any of their rows do."""
    sets = [(d, shingles(t)) for d, t in rows if d is not None]
    top = {d: d for d, _ in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= 90 * len(s | t):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {d: find(d) for d in top}


def same(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"held_id": F.lit(1), "a": F.lit(2)}).repartition(3)
    got = jaccard.join(docs).collect()
    want = components(rows)
    key = lambda r: (r[0] is None, r)
    expected = sorted(((d, len(shingles(t)), want.get(d)) for d, t in rows), key=str)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == expected, key


def test_rows_of_one_document(spark):
    x, y = " ".join(f"x{i}" for i in range(40)), " ".join(f"y{i}" for i in range(40))
    same(spark, [(5, x), (5, y), (2, x), (3, y)])
    same(spark, [(5, x), (5, None), (5, ""), (9, ""), (2, x), (None, x), (None, y), (7, y), (7, y)])


def test_chains_through_documents(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(500)], k=60)) for _ in range(25)]
    near = [t.rsplit(" ", 1)[0] + " end" for t in texts]
    rows = [(rng.randrange(60), rng.choice(texts + near)) for _ in range(80)] + [(70, "one two"), (71, "one two"), (71, texts[0])]
    same(spark, rows)
