"""Whitening against numpy's double precision, exact integers, and odd tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmesh.llm import whitening

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>, x int, component int, n int, label int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in vectors], SCHEMA).repartition(3)


def usable(v, d):
    return v is not None and len(v) == d and all(c is not None and np.isfinite(c) for c in v)


def expected(vectors, d, k=4):
    """By numpy over the whole matrix: n, deviations as Python's integers, whitened, explained."""
    rows = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(np.int64)) for i, v in vectors if usable(v, d)]
    fit = np.unique(np.stack([x for _, x in rows]), axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(x, s, strict=True)) for _, x in rows]
    return n, [i for i, _ in rows], deviation, np.stack([(x - s / n) @ u / np.sqrt(e) for _, x in rows]), e / np.trace(v)


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 7)) * [5, 3, 2, 1, 1, 0.5, 0.1]
    vectors = [(i, v.tolist()) for i, v in enumerate(base.astype(np.float32))]
    vectors += [(i, base[0].tolist()) for i in range(300, 420)]  # copies weigh nothing
    vectors += [(5, base[9].tolist()), (None, base[1].tolist())]  # repeated and missing ids stay rows
    bad = [(900, None), (901, []), (902, [1.0, None] + [0.0] * 5), (903, [NAN] + [0.0] * 6), (904, [INF] + [0.0] * 6), (905, [1.0, 2.0]), (906, [3e38] * 7)]
    got = whitening.report(table(spark, vectors + bad)).collect()
    n, ids, deviation, z, explained = expected(vectors, 7)
    assert len(got) == 4 * len(ids)
    assert sorted({r["component"] for r in got}) == [1, 2, 3, 4]
    assert {r["n"] for r in got} == {n} and n == 300
    assert {r["vec_id"] for r in got} == set(ids)
    for c in range(4):
        mine = [r for r in got if r["component"] == c + 1]
        assert abs(mine[0]["explained"] - explained[c]) < 1e-12
        rank = lambda t: (t[0] is None, t[0] or 0, t[1])
        mine = sorted(((r["vec_id"], r["deviation"], r["whitened"]) for r in mine), key=rank)
        want = sorted(zip(ids, deviation, z[:, c], strict=True), key=rank)
        assert [m[:2] for m in mine] == [w[:2] for w in want]
        a, b = np.array([m[2] for m in mine]), np.array([w[2] for w in want])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-10
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


@pytest.mark.parametrize("values", [
    np.linspace(1, 100, 40), np.r_[[5.0] * 4, [5 + 1e-9] * 3, [5 + 1e-6] * 3, np.linspace(0.1, 3, 30)], np.r_[[3.0, 2.0, 1.0], np.zeros(37)],
    np.r_[[10, 10 - 1e-7, 10 - 2e-7, 10 - 1e-3], np.ones(36)], np.ones(40), np.geomspace(1, 1e-12, 40), np.array([2.0]), np.zeros(5),
])
def test_refined_eigenpairs(values):
    """Eigenvalues, residuals and angles to double precision, also within clusters that float32 can't tell apart."""
    rng = np.random.default_rng(len(values))
    q, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
    v = (q * values) @ q.T
    v = (v + v.T) / 2
    e, x = whitening.eigenpairs(v)
    tiny = 1e-14 * max(1.0, values.max())
    assert np.abs(e - np.sort(values)[::-1]).max() < 20 * tiny
    assert np.abs(v @ x - x * e).max() < 20 * tiny
    assert np.abs(x.T @ x - np.eye(len(v))).max() < 1e-13


def test_one_round_squares_the_error():
    """The iteration itself: from a start that is off by 1e-4 a round leaves about 1e-8."""
    rng = np.random.default_rng(8)
    q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    v = (q * np.arange(12, 0, -1.0)) @ q.T
    x, _, first = whitening.refine(v, q + 1e-4 * rng.normal(size=q.shape))
    _, e, second = whitening.refine(v, x)
    assert 1e-5 < first < 1e-2 and second < 1e-5
    assert np.abs(e - np.arange(12, 0, -1.0)).max() < 1e-9


def test_sums_and_deviations_beyond_longs(spark):
    rng = random.Random(2)
    vectors = [(i, [rng.uniform(-3e13, 3e13) for _ in range(3)]) for i in range(50)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = {(r["vec_id"], r["component"]): r for r in whitening.report(df).collect()}
    rows = [(i, [int(np.floor(256 * c)) for c in v]) for i, v in vectors]
    sums = [sum(x[j] for _, x in rows) for j in range(3)]
    for i, x in rows:
        exact = sum((50 * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        assert int(got[i, 1]["deviation_exact"]) == exact if exact < 10**38 else got[i, 1]["deviation_exact"] is None
        assert got[i, 1]["deviation"] is None
    assert all(r["identity_error"] < 1e-9 for r in got.values()) and len(got) == 150


def test_tables_without_variance_or_rows(spark):
    same = whitening.report(table(spark, [(i, [1.0, 2.0]) for i in range(6)])).collect()
    assert len(same) == 12 and all(r["n"] == 1 and r["whitened"] is None and r["explained"] == 0 and r["deviation"] == 0 and r["identity_error"] is None for r in same)
    flat = whitening.report(table(spark, [(i, [float(i), 2.0]) for i in range(6)])).collect()  # one entry never varies
    assert {r["component"]: r["whitened"] is None for r in flat} == {1: False, 2: True}
    assert all(r["explained"] == (1.0 if r["component"] == 1 else 0.0) and r["identity_error"] < 1e-12 for r in flat)
    for empty in ([], [(1, None)], [(1, []), (2, [])], [(1, [NAN])]):
        got = whitening.report(table(spark, empty))
        assert got.count() == 0 and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"]


def test_lengths_as_frequent(spark):
    """Of lengths as frequent the longest stays."""
    got = whitening.whiten(table(spark, [(1, [1.0]), (2, [2.0]), (3, [1.0, 2.0]), (4, [0.0, 5.0])])).agg(F.collect_set("vec_id")).first()[0]
    assert sorted(got) == [3, 4]
