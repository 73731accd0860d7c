"""The index against a full scan: exact search, recall of probing, pruned partitions, odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmesh.operators import vector_index, vectors


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(3)
    around = rng.normal(size=(20, 16))
    x = np.r_[around[rng.integers(0, 20, 1500)] + 0.4 * rng.normal(size=(1500, 16)), rng.normal(size=(300, 16))]
    rows = [(i, v.tolist(), "a") for i, v in enumerate(x.astype(np.float32))] + [(2000 + i, x[0].tolist(), "copy") for i in range(30)] + [(3000, None, "none"), (3001, [0.0] * 16, "zero")]
    return spark.createDataFrame(rows, "id long, embedding array<float>, label string").repartition(4).cache()


@pytest.fixture(scope="module")
def index(spark, docs, tmp_path_factory):
    return vector_index.build(docs, str(tmp_path_factory.mktemp("index") / "i"))


def hits(rows):
    return [(r.id, r.cosine, r.score, r.label) for r in rows.collect()]


def test_exact_search_equals_the_scan(docs, index):
    assert index.sizes.sum() == 1830 and len(index.cells) > 20
    questions = [r.embedding for r in docs.filter("id % 300 = 7").orderBy("id").collect()] + [[1.0] * 16, [-1.0] + [0.0] * 15]
    read = []
    for q in questions:
        got = vector_index.search(index, q, 7)
        assert hits(got) == hits(vectors.nearest(docs, q, 7).select(*got.columns)) and got.columns == ["id", "embedding", "label", "cosine", "score"]
        read.append(len(vector_index.reachable(index, q, min(h[1] for h in hits(got)))))
    assert min(read) < len(index.cells) / 2  # cells that can't hold a hit are left out


def test_probing_reaches_the_recall(docs, index):
    found = wanted = 0
    for r in docs.filter("id % 60 = 1 and label = 'a'").orderBy("id").collect():
        near = {h[0] for h in hits(vectors.nearest(docs, r.embedding, 10))}
        got = {h[0] for h in hits(vector_index.search(index, r.embedding, 10, probes=8))}
        found, wanted = found + len(near & got), wanted + len(near)
    assert wanted == 300 and found >= 0.9 * wanted


def test_only_probed_partitions_are_read(index):
    q = [1.0] + [0.0] * 15
    cells = sorted(int(c) for c in vector_index.probed(index, q, 5, 3))
    plan = index.rows(vector_index.probed(index, q, 5, 3))._jdf.queryExecution().executedPlan().toString()
    assert len(cells) == 3 and "PartitionFilters: [cell" in plan
    read = index.rows(vector_index.probed(index, q, 5, 3)).select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split("cell=")[1].split("/")[0] for r in read} == {str(c) for c in cells}


def test_loading_and_small_indexes(spark, docs, index, tmp_path):
    again = vector_index.load(spark, index.path)
    assert np.array_equal(again.cells, index.cells) and np.allclose(again.angles, index.angles)
    few = vector_index.build(docs.limit(3), str(tmp_path / "few"))
    assert len(hits(vector_index.search(few, [1.0] * 16, 10))) == 3  # more asked for than there are
    one = vector_index.build(docs.filter("label = 'copy'"), str(tmp_path / "one"), cells=4)
    assert [h[0] for h in hits(vector_index.search(one, [1.0] * 16, 4))] == [2000, 2001, 2002, 2003]  # ties by key
    none = vector_index.build(docs.filter("label in ('none', 'zero')"), str(tmp_path / "none"))
    assert hits(vector_index.search(none, [1.0] * 16, 4)) == []
