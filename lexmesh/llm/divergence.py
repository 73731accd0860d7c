"""Source divergence audit: how far each source's terms are from its language's and from the other sources'.

Equal texts of a language are collapsed first: tables of (language, text hash, source) say how often each source has
them, and one of the copies is split into terms, whose occurrences and documents count as often as the text stands
there. Texts that a bitmap of hashes shows to stand once aren't moved for that. A term is a run of letters (A-Z lower-cased, all beyond ASCII as they are). A language keeps the terms of at
least 10 of its documents. A group (language, source) gives each kept term the share
p = 1 + floor(10^9 (count + 2) / (N + 2 V)), and two shares p, q are f = floor((p - q)^2 / (p + q)) apart.

Pairs of sources are evaluated sparsely. Where a group lacks a term its share is one number, `base`. With A and B the
kept terms that two groups have, the sum of f over all V terms is exactly
  sum over A of f(p, base_b) + sum over B of f(base_a, q) + (V - |A| - |B|) f(base_a, base_b)
  + sum over A and B of f(p, q) - f(p, base_b) - f(base_a, q) + f(base_a, base_b).
The first two come from how many terms of a group have the same share, the last from rows of (term, up to 64 sources),
whose pairs are summed in tasks as matrices: no row is made for a term and a pair of sources.

Null text, lang and source are ''. Texts without terms count as documents of their group, which is reported even if
it has none. Repeated rows and ids are documents of their own. A language that keeps no term has pairs of value 0. A
lone source has no pairs. Empty tables give no rows; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NOT_LETTER, byte_table, cut, held_twice, in_bitmap, iter_words, sliced

LEAST_DOCUMENTS, TOP = 10, 10
#: Sources whose pairs make one matrix, and sources a collapsed text carries at most in one row.
WIDTH, LISTED = 64, 4096
#: Counters that a task holds before it passes them on, and numbers in a block of shares.
HELD, AT_ONCE = 1 << 18, 1 << 18

_TABLE = byte_table(NOT_LETTER, lower=True)


def collapsed(docs: DataFrame, parts: int) -> DataFrame:
    """(lang, source, term, count, docs) with each text of a language split into terms once; a key may have several rows.

    Texts that surely stand once, by a bitmap of the hashes that may stand twice, stay where they are; only the
    others are shuffled. parts: into so many rows a text's sources are dealt, by a hash of the source, so that no
    list is unbounded.
    """
    rows = docs.withColumn("h1", F.xxhash64("lang", "text"))
    twice = docs.sparkSession.sparkContext.broadcast(held_twice(rows.select("h1")))
    alone = rows.select("lang", "text", F.array(F.struct("source", F.lit(1).cast("long").alias("n"))).alias("sources"), "h1")
    return _terms(alone, twice).unionByName(_terms(repeated(rows, twice, parts)))


def repeated(rows: DataFrame, twice, parts: int) -> DataFrame:
    """(lang, text, sources): the texts whose hash may stand twice, each of a language once, with (source, n) of those that have it."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            yield b.filter(pa.array(in_bitmap(twice.value, b.column("h1").to_numpy())))

    hashed = rows.select("lang", "source", "text", "h1").mapInArrow(keep, "lang string, source string, text string, h1 long").withColumn("h2", F.xxhash64(F.lit(1), "text"))
    keys = ["lang", "h1", "h2"]
    counted = hashed.groupBy(*keys, "source").agg(F.count("*").alias("n"))
    part = F.pmod(F.xxhash64("source"), F.lit(parts))
    sources = counted.groupBy(*keys, part.alias("part")).agg(F.collect_list(F.struct("source", "n")).alias("sources"))
    return hashed.select(*keys, "text").dropDuplicates(keys).join(sources, keys).select("lang", "text", "sources")


def _terms(texts: DataFrame, twice=None) -> DataFrame:
    """The terms of texts (lang, text, sources); with a bitmap, of those alone whose h1 isn't in it."""
    kind = "lang string, source string, term string, count long, docs long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], int] = {}
        spelled: dict[int, bytes] = {}
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def merged() -> tuple[np.ndarray, ...]:
            group, term, n, docs = map(np.concatenate, zip(*held, strict=True))
            order = np.lexsort((term, group))
            group, term = group[order], term[order]
            at = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (term[1:] != term[:-1])])
            return group[at], term[at], np.add.reduceat(n[order], at), np.add.reduceat(docs[order], at)

        def out(group: np.ndarray, term: np.ndarray, n: np.ndarray, docs: np.ndarray) -> Iterator[pa.RecordBatch]:
            langs, sources = (pa.array([g[k] for g in groups]) for k in (0, 1))
            for lo in range(0, len(group), 1 << 16):
                some = slice(lo, lo + (1 << 16))
                which = pa.array(group[some])
                words = pa.array([spelled[t] for t in term[some].tolist()], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([langs.take(which), sources.take(which), words, pa.array(n[some]), pa.array(docs[some])], ["lang", "source", "term", "count", "docs"])

        for b in sliced(batches):
            if twice is not None:
                b = b.filter(pa.array(~in_bitmap(twice.value, b.column("h1").to_numpy())))
                if not b.num_rows:
                    continue
            listed = b.column("sources")
            ends = np.r_[0, np.cumsum([len(x) for x in listed])]
            flat = listed.flatten()
            langs = b.column("lang").take(pa.array(np.repeat(np.arange(b.num_rows), np.diff(ends)))).to_pylist()
            code = np.array([groups.setdefault(g, len(groups)) for g in zip(langs, flat.field("source").to_pylist(), strict=True)], np.int64)
            times = flat.field("n").to_numpy(zero_copy_only=False)
            for w in iter_words(b.column("text"), _TABLE):
                if not len(w.hash):
                    continue
                term, first, which = np.unique(w.hash, return_index=True, return_inverse=True)
                data = w.data.tobytes()
                for h, i in zip(term.tolist(), first.tolist(), strict=True):
                    if h not in spelled:
                        spelled[h] = data[w.start[i] : w.end[i]]
                text = np.repeat(np.arange(w.lo, w.hi), np.diff(w.first))
                each, n = np.unique(text * len(term) + which, return_counts=True)
                text, which = np.divmod(each, len(term))
                # each (text, term) once for every source that has the text
                lo, copies = ends[text], np.diff(ends)[text]
                back = np.repeat(np.arange(len(each)), copies)
                at = lo[back] + np.arange(len(back)) - np.repeat(np.cumsum(copies) - copies, copies)
                held.append((code[at], term[which[back]], n[back] * times[at], times[at]))
                size += len(at)
                if size > HELD:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > HELD // 2:
                        yield from out(*held[0])
                        held, size = [], 0
                        spelled.clear()
        if held:
            yield from out(*merged())

    return texts.mapInArrow(count, kind)


def _share(count: str, n: str = "n", v: str = "v") -> F.Column:
    """1 + floor(10^9 (count + 2) / (n + 2 v)) in longs, three digits at a time; null where a language keeps nothing."""
    whole = f"nullif({n} + 2 * {v}, 0L)"
    one = f"({count} + 2) * 1000L"
    two = f"({one} % {whole}) * 1000L"
    three = f"({two} % {whole}) * 1000L"
    return F.expr(f"1L + ({one} div {whole}) * 1000000L + ({two} div {whole}) * 1000L + {three} div {whole}")


def _apart(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div ({p} + {q}))"


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


def _shared_terms(shares: DataFrame) -> DataFrame:
    """(lang, a, b, value) of slots a < b: the last of the four sums above, over terms that both have."""
    entry = F.struct(F.expr(f"CAST(slot % {WIDTH} AS INT)").alias("at"), "p", "base")
    blocks = shares.groupBy("lang", "term", F.expr(f"CAST(slot div {WIDTH} AS INT)").alias("block")).agg(F.collect_list(entry).alias("has"))
    left, right = (blocks.select("lang", "term", F.col("block").alias(f"{k}_block"), F.col("has").alias(f"{k}_has")) for k in "ab")
    within = left.withColumns({"b_block": F.col("a_block"), "b_has": F.col("a_has")})
    across = left.join(right.filter("b_block > 0"), ["lang", "term"]).filter("a_block < b_block")
    rows = within.unionByName(across).drop("term")

    def dense(has: pa.Array, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shares of the rows as a matrix, base where a row lacks a slot, and the bases."""
        ends = np.r_[0, np.cumsum([len(x) for x in has])]
        flat = has.flatten()
        at, p, base = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("at", "p", "base"))
        bases = np.ones(int(at.max()) + 1, np.int64)
        bases[at] = base
        out = np.tile(bases, (len(rows), 1))
        out[np.repeat(np.arange(len(rows)), np.diff(ends)), at] = p
        return out, bases

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            made = []
            for (lang, i, j), total in held.items():
                a, b = np.nonzero(total)
                a_slot, b_slot = a + i * WIDTH, b + j * WIDTH
                ahead = a_slot < b_slot
                made += zip([lang] * int(ahead.sum()), a_slot[ahead].tolist(), b_slot[ahead].tolist(), total[a, b][ahead].tolist(), strict=True)
            columns = list(zip(*made, strict=True)) or [[], [], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["lang", "a", "b", "value"])

        for batch in batches:
            keys = list(zip(batch.column("lang").to_pylist(), batch.column("a_block").to_pylist(), batch.column("b_block").to_pylist(), strict=True))
            found = {k: i for i, k in enumerate(dict.fromkeys(keys))}
            which = np.array([found[k] for k in keys])
            for key, i in found.items():
                rows = np.flatnonzero(which == i)
                (p, p0), (q, q0) = (dense(batch.column(f"{k}_has").take(pa.array(rows)), rows) for k in "ab")
                total = held.setdefault(key, np.zeros((WIDTH, WIDTH), np.int64))[: len(p0), : len(q0)]
                step = max(1, AT_ONCE // (len(p0) * len(q0)))
                for lo in range(0, len(rows), step):
                    x, y = p[lo : lo + step, :, None], q[lo : lo + step, None, :]
                    total += (_f(x, y) - _f(x, q0[None, None, :]) - _f(p0[None, :, None], y) + _f(p0[:, None], q0[None, :])).sum(axis=0)
            if len(held) >= 64:
                yield out()
                held.clear()
        yield out()

    return rows.mapInArrow(add, "lang string, a long, b long, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): `pair` rows for each other source, `term` rows for the terms that stand out most."""
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    slot = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - F.lit(1)
    groups = cut(docs.select("lang", "source").distinct().withColumn("slot", slot.cast("long")))
    most = groups.agg(F.max("slot")).first()[0] or 0
    counted = collapsed(docs, 1 + most // LISTED).groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    # a row for each source of a term at most, however many documents have it
    alike = Window.partitionBy("lang", "term")
    counted = counted.withColumns({"lang_count": F.sum("count").over(alike), "docs": F.sum("docs").over(alike)})
    rows = cut(counted.filter(F.col("docs") >= least).drop("docs"))
    whole = rows.groupBy("lang").agg(F.sum("count").alias("lang_n"))
    whole = whole.join(rows.select("lang", "term").distinct().groupBy("lang").agg(F.count("*").alias("v")), "lang")
    sums = rows.groupBy("lang", "source").agg(F.sum("count").alias("n"), F.count("*").alias("has"))
    groups = groups.join(sums, ["lang", "source"], "left").join(whole, "lang", "left").fillna(0, ["n", "has", "lang_n", "v"])
    groups = cut(groups.withColumn("base", _share("0L")))

    shares = rows.join(groups, ["lang", "source"]).withColumn("p", _share("count"))
    stands_out = shares.withColumn("q", _share("lang_count", "lang_n")).filter("p > q").withColumn("value", F.expr(_apart("p", "q")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = stands_out.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    terms = terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)

    alike = shares.groupBy("lang", "slot", "p").agg(F.count("*").alias("terms"))
    bases = groups.select("lang", F.col("base").alias("other")).filter("other is not null").distinct()
    alone = alike.join(bases, "lang").groupBy("lang", "slot", "other").agg(F.sum(F.expr(f"terms * {_apart('p', 'other')}")).alias("alone"))
    both = _shared_terms(shares.select("lang", "term", "slot", "p", "base"))

    a, b = (groups.select("lang", "v", *(F.col(c).alias(f"{k}_{c}") for c in ("slot", "source", "has", "base"))) for k in "ab")
    pairs = a.join(b.drop("v"), "lang").filter("a_slot < b_slot")
    for k, other in ("ab", "ba"):
        lone = alone.select("lang", F.col("slot").alias(f"{k}_slot"), F.col("other").alias(f"{other}_base"), F.col("alone").alias(f"{k}_alone"))
        pairs = pairs.join(lone, ["lang", f"{k}_slot", f"{other}_base"], "left")
    pairs = pairs.join(both.select("lang", F.col("a").alias("a_slot"), F.col("b").alias("b_slot"), F.col("value").alias("both")), ["lang", "a_slot", "b_slot"], "left")
    neither = f"(v - a_has - b_has) * {_apart('a_base', 'b_base')}"
    pairs = pairs.withColumn("value", F.expr(f"coalesce(a_alone, 0L) + coalesce(b_alone, 0L) + coalesce(both, 0L) + coalesce({neither}, 0L)"))
    ends = F.explode(F.array(*(F.struct(F.col(f"{k}_source").alias("source"), F.col(f"{o}_source").alias("item")) for k, o in ("ab", "ba"))))
    pairs = pairs.select("lang", "value", ends.alias("end")).select("lang", "end.source", F.lit("pair").alias("part"), "end.item", "value")
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(terms)
