"""N-gram Jaccard join by signature trees.

A document's set: its distinct n-word shingles, as 64-bit hashes; with fewer words the whole sequence is
one. Equal sets are one class, so copies cost a row each and nothing more. Two sets link when their
Jaccard similarity is at least PERCENT / 100.

Candidates come from signature trees (`cells.Forest`): leaves hold the bitmap of a set, nodes the OR of their
children and their range of sizes, and a dual traversal prunes pairs of nodes by the largest overlap their
bitmaps and sizes allow. One tree over all sets would meet nearly all pairs, as bitmaps of unrelated texts fill
up a few levels above the leaves. So there are many trees, and sets are dealt to them without loss: sets that
link differ in at most d shingles, so of d + 1 and more parts of the hash range some part is the same in both,
and its content is the key of a tree. Sizes go by bands, a set stands in its own and the next smaller one. What
the trees leave is verified on the shingles themselves. Components come by alternating stars.

Nulls: null texts and texts without words have an empty set and link with nothing. Rows with the same
doc_id stand for one document, linked by what any of them holds; rows without one are by themselves and have no
component. Empty tables give no rows; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cells import grouped, shared
from .common import SPACES, byte_table, cut, held_once, in_bitmap, iter_words, mix64, sliced, tidy, unused
from .components import connected

SHINGLE, PERCENT = 3, 90
BITS = 2048

_TABLE = byte_table(SPACES, lower=True)
_SALT = np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95) | np.uint64(1)


def _sets(column: pa.Array, shingle: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text."""
    for w in iter_words(column, _TABLE):
        n = np.diff(w.first)
        rolled = np.zeros(max(len(w.hash) - shingle + 1, 0), np.uint64)
        for k in range(shingle if len(rolled) else 0):
            rolled += w.hash[k : len(w.hash) - shingle + 1 + k] * _SALT[k]
        rolled = mix64(rolled)
        for i in range(w.hi - w.lo):
            a = w.first[i]
            if n[i] >= shingle:
                yield w.lo + i, np.unique(rolled[a : a + n[i] - shingle + 1])
            elif n[i]:
                yield w.lo + i, mix64((w.hash[a : a + n[i]] * _SALT[32 : 32 + n[i]]).sum(keepdims=True) + np.uint64(n[i]))
            else:
                yield w.lo + i, np.zeros(0, np.uint64)


def bands(percent: int, up_to: int) -> list[int]:
    """First sizes of the bands: sets that link lie in the same or in neighbouring ones."""
    starts = [1]
    while starts[-1] <= up_to:
        starts.append(100 * starts[-1] // percent + 1)
    return starts


def _differences(starts: list[int], k: int, percent: int) -> int:
    """Most shingles that two linked sets, the smaller of band k, can have apart."""
    small = starts[k + 1] - 1
    return (100 - percent) * (small + 100 * small // percent) // (100 + percent)


def part_keys(t: np.ndarray, percent: int) -> np.ndarray:
    """The keys of a set: hashes of its parts, for its own band and the next smaller one.

    Parts without shingles are no key, unless a set has so many that the pigeonhole needs them: then its
    partner has as many, and both have those keys.
    """
    starts = bands(percent, len(t))
    own = int(np.searchsorted(starts, len(t), "right")) - 1
    out = []
    high = t >> np.uint64(32)
    for k in {own, max(own - 1, 0)}:
        d = _differences(starts, k, percent)
        parts = d + 2 + d // 8
        place = ((high * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
        sums = np.add.reduceat(mix64(t + np.uint64(k + 1)), np.flatnonzero(np.r_[True, place[1:] != place[:-1]]))
        full = place[np.r_[True, place[1:] != place[:-1]]]
        if parts - len(full) >= parts - d:
            empty = np.setdiff1d(np.arange(parts), full)
            full, sums = np.r_[full, empty], np.r_[sums, np.zeros(len(empty), np.uint64)]
        out.append(mix64(mix64(sums) + (full.astype(np.uint64) << np.uint64(16)) + np.uint64(k)))
    return np.concatenate(out)


def _signature(t: np.ndarray) -> np.ndarray:
    bits = np.zeros(BITS, np.uint8)
    bits[(mix64(t ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(BITS - 1)).astype(np.int64)] = 1
    return np.packbits(bits)


def _sums(t: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that tell sets apart."""
    return (int(mix64(t + np.uint64(1)).sum().view(np.int64)), int(mix64(t + np.uint64(2)).sum().view(np.int64))) if len(t) else (0, 0)


def _row(docs: DataFrame):
    """Names a row by its doc_id and text: rows that share both are the same to this operator."""
    return F.xxhash64(docs["doc_id"].cast("long"), docs["text"].cast("string"))


def sets(docs: DataFrame, shingle: int, percent: int, keyed: bool) -> DataFrame:
    """(row, doc_id, n_shingles, s1, s2, keys): keys are empty for an empty set, or if not asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            n, s1, s2, keys = [], [], [], []
            for _, t in _sets(b.column("text"), shingle):
                n.append(len(t))
                one, two = _sums(t)
                s1.append(one)
                s2.append(two)
                keys.append(part_keys(t, percent).view(np.int64) if keyed and len(t) else np.zeros(0, np.int64))
                if len(n) == 2000:
                    yield _batch(b, n, s1, s2, keys)
                    b, n, s1, s2, keys = b.slice(len(n)), [], [], [], []
            yield _batch(b, n, s1, s2, keys)

    def _batch(b, n, s1, s2, keys) -> pa.RecordBatch:
        offsets = np.cumsum([0, *map(len, keys)]).astype(np.int32)
        flat = pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64))
        lists = pa.ListArray.from_arrays(pa.array(offsets), flat)
        return pa.RecordBatch.from_arrays([b.column("row").slice(0, len(n)), b.column("doc_id").slice(0, len(n)), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), lists], ["row", "doc_id", "n_shingles", "s1", "s2", "keys"])

    slim = docs.select(_row(docs).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "row long, doc_id long, n_shingles long, s1 long, s2 long, keys array<long>")


def _contents(docs: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """(id, signature, size, spare, shingles) of the classes in ids (id, row), from the text of that row.

    A bitmap of the rows goes to the texts, so that these needn't be shuffled; what it lets through is joined.
    """
    names = ["id", "signature", "size", "spare", "shingles"]
    held = docs.sparkSession.sparkContext.broadcast(held_once(ids.select("row")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in sliced(batches):
            whole = whole.filter(pa.array(in_bitmap(held.value, whole.column("row").to_numpy())))
            for lo in range(0, whole.num_rows, 1000):
                found = [t for _, t in _sets(whole.column("text").slice(lo, 1000), shingle)]
                signs = [_signature(t) for t in found]
                spare = [len(t) - int(np.bitwise_count(x).sum()) for t, x in zip(found, signs, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([_sums(t)[0] for t in found], pa.int64()), pa.array([x.tobytes() for x in signs], pa.binary()), pa.array([len(t) for t in found], pa.int32()), pa.array(spare, pa.int32()), pa.array([t.view(np.int64) for t in found], pa.list_(pa.int64()))], names)

    texts = docs.select(_row(docs).alias("row"), F.col("text").cast("string").alias("text"))
    rows = texts.mapInArrow(run, "id long, signature binary, size int, spare int, shingles array<long>")
    return rows.join(ids.select("id"), "id", "left_semi").dropDuplicates(["id"])


def rewritten(docs: DataFrame) -> DataFrame:
    """(doc_id): ids whose rows hold different texts. Counted on hashes of whole texts, summed before the shuffle."""
    h = F.xxhash64(F.col("text").cast("string"))
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), h.alias("h")).filter("doc_id is not null")
    return cut(named.groupBy("doc_id").agg(F.min("h").alias("low"), F.max("h").alias("high")).filter("low <> high").select("doc_id"))


def _held(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs with one of the ids."""
    (key,) = unused(docs.columns, "held_id")
    return docs.join(ids.select(F.col("doc_id").alias(key)), F.col("doc_id").cast("long") == F.col(key), "left_semi")


def components(docs: DataFrame, shingle: int, percent: int, nameless: bool = False, several: DataFrame | None = None) -> DataFrame:
    """(s1, s2, n_shingles, best) of the classes that more than one document belongs to.

    several: ids of documents whose rows hold different texts; the classes of all rows of one are linked.

    best is (nameless, doc_id, row) of the first row of the component, in that order. A class goes by s1, its
    64-bit hash. Rows without a doc_id take part only if nameless is asked for, behind all others.
    """
    named = sets(docs, shingle, percent, True).filter("n_shingles > 0")
    if not nameless:
        named = named.filter("doc_id is not null")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row"))
    alike = named.groupBy("s1", "s2", "n_shingles").agg(best.alias("best"), F.first("keys").alias("keys"), F.count("*").alias("copies"))
    classes = cut(alike.withColumn("id", F.col("s1")))
    cells = cut(shared(classes.select("id", "keys")))
    tidy(docs.sparkSession)
    ids = cut(classes.select("id", F.col("best.row").alias("row")).join(cells.select("id").distinct(), "id", "left_semi"))
    about = cut(_contents(docs, ids, shingle))
    tidy(docs.sparkSession)
    shingles = about.select("id", "shingles", "size")

    def verify(pairs: DataFrame) -> DataFrame:
        left, right = (shingles.select(F.col("id").alias(k), F.col("shingles").alias(f"s{k}"), F.col("size").alias(f"n{k}")) for k in "ab")
        both = F.size(F.array_intersect("sa", "sb"))
        return pairs.join(left, "a").join(right, "b").filter((100 + percent) * both >= percent * (F.col("na") + F.col("nb"))).select("a", "b")

    found = grouped(cells, about.drop("shingles"), enough(percent), verify, connected)
    if several is not None:
        own = sets(_held(docs, several), shingle, percent, False).filter("n_shingles > 0").select("doc_id", F.col("s1").alias("a"))
        same = own.join(own.groupBy("doc_id").agg(F.min("a").alias("b")), "doc_id").select("a", "b")
        found = connected(found.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(same)).select(F.col("node").alias("id"), "component")
    joined = classes.drop("keys").join(found, "id", "left").filter("copies > 1 or component is not null").withColumn("component", F.coalesce("component", "id"))
    first = joined.groupBy("component").agg(F.min("best").alias("first"))
    return joined.join(first, "component").select("s1", "s2", "n_shingles", F.col("first").alias("best"))


def enough(percent: int):
    """Whether sets of a and b elements with `most` in common can reach the similarity."""
    return lambda most, a, b: (100 + percent) * most >= percent * (a + b)


def join(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, which is the same in all rows of a doc_id."""
    several = rewritten(docs)
    several = None if several.isEmpty() else several
    rows = sets(docs, shingle, percent, False).drop("keys", "row")
    named = components(docs, shingle, percent, several=several)
    out = rows.join(named, ["s1", "s2", "n_shingles"], "left")
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("best.doc_id", "doc_id")).alias("component_id"))
    if several is None:
        return out
    # rows without words follow those of their id that have some
    least = out.join(several, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("component_id").alias("least"))
    return out.join(least, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("least", "component_id").alias("component_id"))


def keep_one(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """docs with one row of each component: that of the smallest doc_id, one without an id only where all lack it.

    Of rows that share doc_id and text one stays, and so do all rows without words. Rows are told apart, not
    ids: rows of one doc_id with different texts are judged by their texts.
    """
    rows = sets(docs, shingle, percent, False).drop("keys").filter("n_shingles > 0")
    named = components(docs, shingle, percent, True)
    judged = cut(rows.join(named, ["s1", "s2", "n_shingles"]).select("row", F.col("best.row").alias("stays")).groupBy("row", "stays").agg(F.count("*").alias("n")))
    (key,) = unused(docs.columns, "jaccard_row")
    gone = judged.filter("row <> stays").select(F.col("row").alias(key)).distinct()
    again = judged.filter("row = stays and n > 1").select(F.col("row").alias(key)).distinct()
    kept = docs.withColumn(key, _row(docs)).join(gone.hint("shuffle_hash"), key, "left_anti")
    if not again.isEmpty():
        kept = cut(kept)
        one = kept.join(again.hint("shuffle_hash"), key, "left_semi").dropDuplicates([key])
        kept = kept.join(again.hint("shuffle_hash"), key, "left_anti").unionByName(one)
    return kept.select(*docs.columns)
