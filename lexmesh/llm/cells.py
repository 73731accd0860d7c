"""Candidate pairs: members that share a key are dealt to a cell, and a signature tree over each cell finds its pairs.

A pair can only be linked if it shares a key. Most keys stand once, so a bitmap of a fixed size says which may
stand twice before any id travels; keys whose members are the same are one cell. A leaf of a cell's tree holds
the bitmap of a member, a node the OR of its children and their range of sizes, and a dual traversal of the tree
with itself, from the root down, prunes pairs of nodes by the largest overlap that bitmaps and sizes allow.

Two rounds find the links. Cells of up to SMALL members are traversed at once; members of larger ones are first
tied to leaders, with a row a member. The second round takes larger cells that hold several components yet, and
is exact: nodes of one component aren't met, so a group of near copies doesn't cost its pairs and no link is
lost. A cell of more than BLOCK members is dealt to units, by component, that have a tree each; the roots of the
units are compared first, and only members of pairs of units that may link are sent on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, held_twice, in_bitmap, tidy

BLOCK, SMALL, FANOUT = 1024, 8, 8
#: Pairs of nodes whose bitmaps are compared at once.
STEP = 8192


def shared(keyed: DataFrame) -> DataFrame:
    """From (id, keys), keys being an array of 64-bit hashes: (cell, id, n) for keys of two ids or more, each set of ids once.

    Cells are told apart by the number, the sum and the xor of 64-bit hashes of their members.
    """
    sc = keyed.sparkSession.sparkContext
    held = sc.broadcast(held_twice(keyed.select("keys")))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, lists = b.column("keys").flatten(), b.column("keys").value_lengths().to_numpy(zero_copy_only=False)
            values = keys.to_numpy(zero_copy_only=False)
            some = in_bitmap(held.value, values)
            ids = np.repeat(b.column("id").to_numpy(), lists)
            yield pa.RecordBatch.from_arrays([pa.array(values[some]), pa.array(ids[some])], ["key", "id"])

    rows = cut(keyed.select("id", "keys").mapInArrow(kept, "key long, id long"))
    sums = rows.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.sum(F.xxhash64("id").bitwiseAND(F.lit((1 << 31) - 1))).alias("y")).filter("n > 1")
    once = sums.groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key", "n")
    return rows.join(once.hint("shuffle_hash"), "key").select(F.col("key").alias("cell"), "id", "n")


class Forest:
    """Signature trees, one per run of equal `tree` in the rows, built level by level at once.

    A level is (bitmaps, least size, largest size, most elements hidden behind equal bits, component or -1,
    first child, children). enough(most, a, b) says whether sets of at least a and b elements may link with an
    overlap of `most`; it must not fall with `most`, nor rise with a and b.
    """

    def __init__(self, bits: np.ndarray, sizes: np.ndarray, spare: np.ndarray, component: np.ndarray, tree: np.ndarray, enough: Callable):
        self.enough = enough
        # members of a component, and of like sizes and bitmaps, stand together, so that nodes stay sparse
        self.order = np.lexsort((bits[:, 0], sizes, component, tree))
        o, tree = self.order, tree[self.order]
        nothing = np.zeros(len(o), np.int64)
        self.levels = [(bits[o], sizes[o], sizes[o], spare[o], component[o], nothing, nothing)]
        while True:
            first = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]]) if len(tree) else np.zeros(0, np.int64)
            if len(first) == len(tree):
                self.roots = tree
                break
            n = np.diff(np.r_[first, len(tree)])
            at = np.flatnonzero((np.arange(len(tree)) - np.repeat(first, n)) % FANOUT == 0)
            b, lo, hi, e, c, *_ = self.levels[-1]
            one = np.where(np.minimum.reduceat(c, at) == np.maximum.reduceat(c, at), c[at], -1)
            self.levels.append((np.bitwise_or.reduceat(b, at, axis=0), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at), np.maximum.reduceat(e, at), one, at, np.diff(np.r_[at, len(tree)])))
            tree = tree[at]

    def _allowed(self, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether some pair of leaves below the nodes may link."""
        bits, lo, hi, spare, component, *_ = self.levels[level]
        keep = (component[i] != component[j]) | (component[i] < 0)
        most = np.minimum(hi[i], hi[j])
        keep &= self.enough(most, lo[i], lo[j])
        for s in range(0, len(i), STEP):
            at = s + np.flatnonzero(keep[s : s + STEP])
            a, b = i[at], j[at]
            if level:
                over = np.minimum(np.bitwise_count(bits[a] & bits[b]).sum(1, dtype=np.int64) + np.minimum(spare[a], spare[b]), most[at])
            else:
                # an element whose bit the other lacks is an element that it lacks
                over = np.minimum(lo[a] - np.bitwise_count(bits[a] & ~bits[b]).sum(1, dtype=np.int64), lo[b] - np.bitwise_count(bits[b] & ~bits[a]).sum(1, dtype=np.int64))
            keep[at] = self.enough(over, lo[a], lo[b])
        return keep

    def traverse(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows, each pair once, that the bounds leave below the roots left[k] and right[k]."""
        i, j = left, right
        for level in range(len(self.levels) - 1, -1, -1):
            keep = (i != j) | (level > 0)
            keep[keep] = self._allowed(level, i[keep], j[keep])
            i, j = i[keep], j[keep]
            if level:
                *_, child, n = self.levels[level]
                k = np.arange(FANOUT)
                fit = (k[:, None] < n[i][:, None, None]) & (k[None, :] < n[j][:, None, None]) & ((i != j)[:, None, None] | (k[:, None] <= k[None, :]))
                pair, x, y = np.nonzero(fit)
                i, j = child[i[pair]] + x, child[j[pair]] + y
        return self.order[i], self.order[j]


def _read(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bits = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint64).reshape(table.num_rows, -1)
    return bits, table.column("size").to_numpy().astype(np.int64), table.column("spare").to_numpy().astype(np.int64)


def _codes(table: pa.Table) -> np.ndarray:
    return np.unique(table.column("component").to_numpy(), return_inverse=True)[1].ravel()


def leaders(bits: np.ndarray, sizes: np.ndarray, run: np.ndarray, enough: Callable) -> tuple[np.ndarray, np.ndarray]:
    """Each row with the first leader of its run that the leaves' bound allows; rows without one lead.

    In each step the first open row of every run leads, and the open rows that it may link with are settled.
    """
    open_, i, j = np.arange(len(run)), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(open_):
        new = np.r_[True, run[open_][1:] != run[open_][:-1]]
        lead, rest = open_[np.flatnonzero(new)[np.cumsum(new) - 1]][~new], open_[~new]
        near = np.zeros(len(rest), bool)
        for s in range(0, len(rest), STEP):
            a, b = lead[s : s + STEP], rest[s : s + STEP]
            over = np.minimum(sizes[b] - np.bitwise_count(bits[b] & ~bits[a]).sum(1, dtype=np.int64), sizes[a] - np.bitwise_count(bits[a] & ~bits[b]).sum(1, dtype=np.int64))
            near[s : s + STEP] = enough(over, sizes[b], sizes[a])
        i.append(lead[near])
        j.append(rest[near])
        open_ = rest[~near]
    return np.concatenate(i), np.concatenate(j)


def _whole_runs(names: list[str], work: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]]) -> Callable:
    """A mapInArrow function that hands rows to work(table, run) in whole runs of equal `names`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []

        def whole(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(parts).combine_chunks()
            if table.num_rows:
                key = np.stack([table.column(c).to_numpy() for c in names])
                yield from work(table, np.cumsum(np.r_[False, (key[:, 1:] != key[:, :-1]).any(0)]))

        for b in batches:
            if not b.num_rows:
                continue
            same = np.ones(b.num_rows, bool)
            for c in names:
                x = b.column(c).to_numpy()
                same &= x == x[-1]
            last = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if last == 0 and rest and any(rest[-1].column(c)[-1] != b.column(c)[0] for c in names):
                yield from whole(rest)
                rest = []
            if last:
                yield from whole([*rest, b.slice(0, last)])
                rest = []
            rest.append(b.slice(last))
        if rest:
            yield from whole(rest)

    return run


def _pairs(table: pa.Table, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    ids = table.column("id").to_numpy()
    a, b = np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _first_round(rows: DataFrame, enough: Callable) -> DataFrame:
    """Pairs of small cells by their trees, and members of larger ones with their leaders."""

    def work(table: pa.Table, run: np.ndarray) -> Iterator[pa.RecordBatch]:
        bits, sizes, spare = _read(table)
        n = np.bincount(run)
        small = np.flatnonzero(n[run] <= SMALL)
        if len(small):
            forest = Forest(bits[small], sizes[small], spare[small], np.arange(len(small)), run[small], enough)
            roots = np.arange(len(forest.roots))
            i, j = forest.traverse(roots, roots)
            yield _pairs(table, small[i], small[j])
        large = np.flatnonzero(n[run] > SMALL)
        if len(large):
            i, j = leaders(bits[large], sizes[large], run[large], enough)
            yield _pairs(table, large[i], large[j])

    unit = F.pmod(F.xxhash64("id", "cell"), F.ceil(F.col("n") / BLOCK)).cast("int")
    rows = rows.withColumn("unit", unit).repartition("cell", "unit").sortWithinPartitions("cell", "unit", "id")
    return rows.mapInArrow(_whole_runs(["cell", "unit"], work), "a long, b long").distinct()


def _units(rows: DataFrame, enough: Callable) -> DataFrame:
    """(cell, lo, hi, side, ...): members of large cells in pairs of units whose roots may hold a link, the left unit on side 0."""
    of = F.pmod(F.xxhash64("component"), F.ceil(F.col("n") / BLOCK))
    rows = rows.withColumn("of", of)
    counts = rows.groupBy("cell", "of").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    rows = cut(rows.join(counts, ["cell", "of"]).withColumn("unit", F.shiftleft("of", 24) + F.pmod(F.xxhash64("id"), F.col("parts"))).drop("of", "parts"))

    def roots(table: pa.Table, run: np.ndarray) -> Iterator[pa.RecordBatch]:
        bits, sizes, spare = _read(table)
        ids = table.column("component").to_numpy()
        codes = _codes(table)
        forest = Forest(bits, sizes, spare, codes, run, enough)
        b, lo, hi, e, c, *_ = forest.levels[-1]
        first = np.searchsorted(run, forest.roots)
        one = np.where(c < 0, 0, ids[first])
        columns = [table.column("cell").to_numpy()[first], table.column("unit").to_numpy()[first], lo, hi, e, one, c < 0]
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array([x.tobytes() for x in b], pa.binary())], ["cell", "unit", "lo", "hi", "spare", "one", "mixed", "signature"])

    dealt = rows.repartition("cell", "unit").sortWithinPartitions("cell", "unit")
    tops = dealt.mapInArrow(_whole_runs(["cell", "unit"], roots), "cell long, unit long, lo long, hi long, spare long, one long, mixed boolean, signature binary")

    def meet(table: pa.Table, run: np.ndarray) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint64).reshape(table.num_rows, -1)
        cell, unit, lo, hi, spare, one = (table.column(k).to_numpy() for k in ("cell", "unit", "lo", "hi", "spare", "one"))
        mixed = table.column("mixed").to_numpy()
        ends = np.searchsorted(run, run, "right")
        for i in range(table.num_rows):
            j = np.arange(i, ends[i])
            most = np.minimum(np.minimum(hi[i], hi[j]), np.bitwise_count(bits[i] & bits[j]).sum(1, dtype=np.int64) + np.minimum(spare[i], spare[j]))
            keep = enough(most, lo[i], lo[j]) & ((one[i] != one[j]) | mixed[i] | mixed[j])
            j = j[keep]
            if len(j):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(j), cell[i])), pa.array(np.full(len(j), unit[i])), pa.array(unit[j])], ["cell", "lo", "hi"])

    met = cut(tops.repartition("cell").sortWithinPartitions("cell").mapInArrow(_whole_runs(["cell"], meet), "cell long, lo long, hi long"))
    left = met.join(rows, (met["cell"] == rows["cell"]) & (met["lo"] == rows["unit"])).drop(rows["cell"]).withColumn("side", F.lit(0))
    right = met.filter("lo <> hi").alias("m").join(rows.alias("r"), (F.col("m.cell") == F.col("r.cell")) & (F.col("m.hi") == F.col("r.unit"))).drop(F.col("r.cell")).withColumn("side", F.lit(1))
    return left.unionByName(right).drop("unit")


def _second_round(rows: DataFrame, enough: Callable, large: bool) -> DataFrame:
    """Pairs from different components, by the trees of what is left of the larger cells."""
    mixed = rows.groupBy("cell").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("cell")
    rows = rows.join(mixed, "cell", "left_semi")
    met = rows.filter(F.col("n") <= BLOCK).withColumns({"lo": F.lit(0).cast("long"), "hi": F.lit(0).cast("long"), "side": F.lit(0)})
    if large:
        met = met.unionByName(_units(rows.filter(F.col("n") > BLOCK), enough))

    def work(table: pa.Table, run: np.ndarray) -> Iterator[pa.RecordBatch]:
        forest = Forest(*_read(table), _codes(table), 2 * run + table.column("side").to_numpy(), enough)
        even = forest.roots % 2 == 0
        left = np.flatnonzero(even)
        right = np.where(np.r_[~even[1:], False][left], left + 1, left)
        yield _pairs(table, *forest.traverse(left, right))

    met = met.repartition("cell", "lo", "hi").sortWithinPartitions("cell", "lo", "hi", "side", "id")
    return met.mapInArrow(_whole_runs(["cell", "lo", "hi"], work), "a long, b long").distinct()


def grouped(cells: DataFrame, about: DataFrame, enough: Callable, verify: Callable, components: Callable) -> DataFrame:
    """(id, component) of all that verified links tie together: both rounds.

    about: (id, signature, size, spare) of every id in cells. The first round has met all pairs of the small
    cells, so the second takes the others; its links are between components, and only these are joined further.
    """
    rows = cells.join(about, "id")
    found = components(verify(_first_round(rows, enough)))
    found = cut(found.withColumnsRenamed({"node": "id"}))
    tidy(rows.sparkSession)
    largest = cells.agg(F.max("n")).first()[0] or 0
    if largest <= SMALL:
        return found
    rows = rows.filter(F.col("n") > SMALL).join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    more = cut(verify(_second_round(rows, enough, largest > BLOCK)))
    tidy(rows.sparkSession)
    if more.isEmpty():
        return found
    top: Callable[[str], Column] = lambda k: found.select(F.col("id").alias(k), F.col("component").alias(f"top_{k}"))
    ends = more.join(top("a"), "a", "left").join(top("b"), "b", "left").select(F.coalesce("top_a", "a").alias("a"), F.coalesce("top_b", "b").alias("b"))
    above = cut(components(ends))
    moved = found.join(above.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    alone = above.select(F.col("node").alias("id"), "component").join(found, "id", "left_anti")
    return moved.unionByName(alone)
