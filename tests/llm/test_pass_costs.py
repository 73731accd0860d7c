"""What reaches the driver, and lines compared many pairs at a time."""

import random

import numpy as np
import pyarrow as pa

from lexmesh.llm import common, linededup


def test_bitmap_comes_to_the_driver_compressed(spark, monkeypatch):
    kind = type(spark.range(0))
    collect, got = kind.toArrow, []
    monkeypatch.setattr(kind, "toArrow", lambda self: got.append(collect(self)) or got[-1])
    values = spark.range(5000).selectExpr("xxhash64(id) v")
    bitmap = common.held_once(values)
    held = np.array([r.v for r in values.collect()], np.int64)
    assert len(bitmap) == 1 << (common.BITS - 3)
    assert common.in_bitmap(bitmap, held).all()
    assert common.in_bitmap(bitmap, common.mix64(np.arange(1, 10001, dtype=np.uint64)).view(np.int64)).sum() < 20
    assert sum(t.nbytes for t in got) < 1 << 20


def test_word_hashes_come_from_the_words_bytes_alone():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcé日", k=rng.randint(1, 40))) for _ in range(400)]
    texts = [" " * rng.randint(0, 9) + "-".join(rng.sample(words, 7)) for _ in range(300)] + [None, ""]
    seen = {}
    for w in common.iter_words(pa.array(texts), common.byte_table(common.NOT_ALNUM, lower=True), 500):
        for i, j, h in zip(w.start, w.end, w.hash.tolist(), strict=True):
            assert seen.setdefault(w.data[i:j].tobytes(), h) == h
    assert len(set(seen.values())) == len(seen) > 300


def test_pairs_of_lines_as_by_the_edit_distance(monkeypatch):
    rng = random.Random(5)
    lines = []
    for _ in range(3000):
        x = rng.choices("abcdefgh", k=rng.randint(5, 40))
        y = list(x)
        for _ in range(rng.randint(0, 8)):
            i = rng.randrange(len(y))
            y[i : i + rng.randint(0, 1)] = rng.choices("abcdefgh", k=rng.randint(0, 2)) if len(y) > 5 else ["a", "b"]
        lines.append((x, y))
    # the longer may have more words; words may differ at both ends
    want = [linededup.edits(x, y) <= 0.2 * max(len(x), len(y)) + 1e-9 for x, y in lines]
    left, right = (pa.array([" ".join(p[k]).encode() for p in lines], pa.binary()) for k in (0, 1))
    assert 300 < sum(want) < 2700
    assert linededup.alike_pairs(left, right, 0.8).tolist() == want
    one = pa.array(["one two three four five six seven eight nine ten"] * 4)
    near = pa.array(["one two x four five six seven eight nine ten", "two three four five six seven eight nine ten", "one two three four five six seven eight nine ten eleven", "y one two three four five six seven eight nine"])
    monkeypatch.setattr(linededup, "alike", None)  # one gap settles all but the last, which would need it
    assert linededup.alike_pairs(one.slice(0, 3), near.slice(0, 3), 0.8).all()
