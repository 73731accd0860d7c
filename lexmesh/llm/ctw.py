"""Language-model scoring by context-tree weighting over bytes.

Bytes are taken apart into eight binary decisions. Each context of up to DEPTH bytes that occurs holds, per
decision, a Krichevsky-Trofimov estimate of its training counts, and the estimates of all depths are mixed
with the weights that context-tree weighting gives them: half to a node's own estimate, half to the product of
its children. No context is dropped, so the tree grows with the input. It is a table of (node, counts, weight)
per depth, summed upwards and mixed downwards by joins in which no key has more than 256 rows. Grams of
held-out texts stand in it with a count of 0, which changes no estimate. All counts are over all training
texts. Before a text stand START bytes and after it the END byte, neither of which UTF-8 has, so the model is
a distribution over texts.

The base score is of words. Word counts are kept by 64-bit hash. Words of FREQUENT share or more, at most
1 / FREQUENT of them, and the LOOKED_UP most frequent grams at most are looked up in each task; the others are
joined with their counts or probabilities, and none of these is hot.

Nulls: a null text is empty, with the end as its only token. A null doc_id has no fold: held out. Repeated
rows are counted and scored one by one. Without training texts every estimate is even. An empty table
gives no rows; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, byte_table, cut, iter_words, sliced, text_bytes

DEPTH, FREQUENT, LOOKED_UP = 4, 2.0**-18, 1 << 21
START, END = 0xFE, 0xFF
#: Counts that a task holds before it passes them on.
HELD = 4 << 20

_TABLE = byte_table(SPACES, lower=True)
WORD, GRAM = 0, 1


def _padded(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts with DEPTH start bytes before and the end byte after each; places that are predicted, and where each text's begin."""
    lengths = np.diff(bounds)
    out = np.full(len(raw) + len(lengths) * (DEPTH + 1), START, np.uint8)
    first = bounds[:-1] + np.arange(len(lengths)) * (DEPTH + 1) + DEPTH
    if len(raw):
        out[np.arange(len(raw)) + np.repeat(first - bounds[:-1], lengths)] = raw
    out[first + lengths] = END
    begins = bounds[:-1] + np.arange(len(lengths))
    places = np.arange(len(raw) + len(lengths)) + np.repeat(first - begins, lengths + 1)
    return out, places, begins


def _grams(text: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The byte at each place and the DEPTH before it, the newest lowest."""
    gram = np.zeros(len(places), np.uint64)
    for back in range(DEPTH, -1, -1):
        gram = (gram << np.uint64(8)) | text[places - back]
    return gram


def _merge(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, *(np.bincount(at, weights=np.concatenate([p[k] for p in parts]), minlength=len(keys)).astype(np.int64) for k in (1, 2))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, key, n, m): word hashes of training texts and grams of all texts; n counts in training texts, m in all."""
    held: dict[int, list] = {WORD: [], GRAM: []}
    size = dict.fromkeys(held, 0)

    def out(kind: int) -> pa.RecordBatch:
        keys, n, m = _merge(held[kind])
        held[kind], size[kind] = [], 0
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.view(np.int64)), pa.array(n), pa.array(m)], ["kind", "key", "n", "m"])

    for b in sliced(batches):
        column = b.column("text")
        apart = b.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        data, offsets = text_bytes(column)
        for w in iter_words(column, _TABLE):
            text, places, begins = _padded(data[offsets[w.lo] : offsets[w.hi]], offsets[w.lo : w.hi + 1] - offsets[w.lo])
            gram = _grams(text, places)
            trained = ~apart[w.lo : w.hi]
            place = np.repeat(trained, np.diff(np.append(begins, len(places))))
            for kind, keys, used in ((WORD, w.hash[np.repeat(trained, np.diff(w.first))], True), (GRAM, gram[place], True), (GRAM, gram[~place], False)):
                if len(keys):
                    keys, m = np.unique(keys, return_counts=True)
                    held[kind].append((keys, m if used else np.zeros_like(m), m))
                    size[kind] += len(keys)
                if size[kind] > HELD // 4:
                    merged = _merge(held[kind])
                    held[kind], size[kind] = [merged], len(merged[0])
                    if size[kind] > HELD // 8:
                        yield out(kind)
    for kind in held:
        if held[kind]:
            yield out(kind)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """By Stirling's series, after a shift by eight."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    r = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / y - shift


def _heap(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From counts of 256 bytes, those of a 0 and of a 1 at each of the 255 decisions."""
    both = np.zeros((len(counts), 512))
    both[:, 256:] = counts
    for k in range(255, 0, -1):
        both[:, k] = both[:, 2 * k] + both[:, 2 * k + 1]
    return both[:, 2:512:2], both[:, 3:512:2]


class Tree:
    """A small context tree in memory, with rarer contexts in one child; the query's is the table of `_tree`. `child` leads from a node by the next older byte, `log10` is of each byte at a leaf."""

    def __init__(self, depths: np.ndarray, contexts: np.ndarray, symbols: np.ndarray, counts: np.ndarray):
        """Rows (depth, context, byte, count) of the kept contexts, the newest byte of a context lowest."""
        nodes: list[tuple[int, int]] = [(0, 0)]
        index = {(0, 0): 0}
        for d, c in sorted(set(zip(depths.tolist(), contexts.tolist(), strict=True))):
            if (d, c) not in index:
                index[d, c] = len(nodes)
                nodes.append((d, c))
        table = np.zeros((len(nodes), 256))
        rows = np.array([index[x] for x in zip(depths.tolist(), contexts.tolist(), strict=True)], np.int64)
        np.add.at(table, (rows, symbols), counts)
        parent = np.array([-1] + [index[d - 1, c & ((1 << 8 * (d - 1)) - 1)] for d, c in nodes[1:]], np.int64)
        depth = [d for d, _ in nodes]
        inner = np.unique(parent[1:])
        other = {int(p): len(nodes) + k for k, p in enumerate(inner)}
        rest = table[inner].copy()
        np.subtract.at(rest, np.searchsorted(inner, parent[1:]), table[1:])
        table = np.concatenate([table, rest])
        parent = np.concatenate([parent, inner])
        depth += [depth[p] + 1 for p in inner]
        n = len(table)
        leaf = np.ones(n, bool)
        leaf[inner] = False
        zeros, ones = _heap(table)
        own = log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - 2 * log_gamma(np.array([0.5])) - log_gamma(zeros + ones + 1)
        weighted, below = own.copy(), np.zeros_like(own)
        by_depth = [np.flatnonzero(np.array(depth) == d) for d in range(max(depth) + 1)]
        for at in reversed(by_depth):
            mid = at[~leaf[at]]
            weighted[mid] = np.log(0.5) + np.logaddexp(own[mid], below[mid])
            up = at[parent[at] >= 0]
            np.add.at(below, parent[up], weighted[up])
        share = np.where(leaf[:, None], 1.0, np.exp(np.log(0.5) + own - weighted))
        one = (ones + 0.5) / (zeros + ones + 1)
        mixed, left = np.zeros_like(one), np.ones_like(one)
        for at in by_depth:
            up = at[parent[at] >= 0]
            mixed[up], left[up] = mixed[parent[up]], left[parent[up]]
            mixed[at] += left[at] * share[at] * one[at]
            left[at] *= 1 - share[at]
        p = np.zeros((n, 512))
        p[:, 1] = 0
        for k in range(1, 256):
            q = np.clip(mixed[:, k - 1], 1e-300, 1 - 1e-15)
            p[:, 2 * k] = p[:, k] + np.log10(1 - q)
            p[:, 2 * k + 1] = p[:, k] + np.log10(q)
        self.log10 = p[:, 256:].astype(np.float32)
        self.child = np.repeat(np.arange(n, dtype=np.int32)[:, None], 256, 1)
        for p_, o in other.items():
            self.child[p_] = o
        for k in range(1, len(nodes)):
            self.child[parent[k], nodes[k][1] >> 8 * (nodes[k][0] - 1)] = k


def _log_gamma(x: Column) -> Column:
    """log_gamma of a column."""
    shift = x
    for k in range(1, 8):
        shift = shift * (x + k)
    y = x + 8
    r = 1 / (y * y)
    return (y - 0.5) * F.ln(y) - y + 0.5 * np.log(2 * np.pi) + (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / y - F.ln(shift)


def _decisions(rows: pa.ListArray) -> tuple[np.ndarray, ...]:
    """Of contexts with their (byte, n, m): row of each gram, its byte and m, its decisions' bits and places in the rest: distinct row << 8 | decision, zeros, ones."""
    grams = rows.flatten()
    byte, n, m = (grams.field(k).to_numpy().astype(np.int64) for k in range(3))
    row = np.repeat(np.arange(len(rows)), rows.value_lengths().to_numpy())
    step = np.arange(8)[:, None]
    bits = byte >> (7 - step) & 1
    nodes, at = np.unique(((row << 8) + (1 << step) + (byte >> (8 - step))).ravel(), return_inverse=True)
    of = lambda bit: np.bincount(at, weights=(n * (bits == bit)).ravel(), minlength=len(nodes))
    return row, byte, m, bits, at.reshape(bits.shape), nodes, of(0), of(1)


def _deepest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the contexts of DEPTH bytes add to their parents' decisions: (node, zeros, ones, below)."""
    for b in batches:
        *_, nodes, zeros, ones = _decisions(b.column("grams"))
        own = log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - np.log(np.pi) - log_gamma(zeros + ones + 1)
        context = b.column("context").to_numpy() & ((1 << 8 * (DEPTH - 1)) - 1)
        up, at = np.unique(context[nodes >> 8] << 8 | nodes & 255, return_inverse=True)
        total = lambda x: np.bincount(at, weights=x, minlength=len(up))
        yield pa.RecordBatch.from_arrays([pa.array(up), pa.array(total(zeros).astype(np.int64)), pa.array(total(ones).astype(np.int64)), pa.array(total(own))], ["node", "zeros", "ones", "below"])


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, m, log10) of the grams of contexts beside the mixture of their parents."""
    for b in batches:
        row, byte, m, bits, at, nodes, zeros, ones = _decisions(b.column("grams"))
        above = b.column("above")
        k, mixed, left = (above.flatten().field(i).to_numpy() for i in range(3))
        up = np.repeat(np.arange(len(above)), above.value_lengths().to_numpy()) << 8 | k
        order = np.argsort(up)
        found = order[np.searchsorted(up[order], nodes)]
        one = mixed[found] + left[found] * (ones + 0.5) / (zeros + ones + 1)
        p = np.where(bits == 1, one[at], 1 - one[at])
        yield pa.RecordBatch.from_arrays([pa.array(b.column("context").to_numpy()[row] << 8 | byte), pa.array(m), pa.array(np.log10(p).sum(0))], ["key", "m", "log10"])


def _tree(grams: DataFrame) -> DataFrame:
    """(key, m, log10) from (key, n, m) of all grams: log10 is of the gram's last byte after its context.

    A node is a decision in a context: the bytes of the context and the bits decided before, after a 1. The
    deepest contexts are a row each, with their grams.
    """
    byte = F.col("key").bitwiseAND(F.lit(255))
    contexts = cut(grams.groupBy(F.shiftrightunsigned("key", 8).alias("context")).agg(F.collect_list(F.struct(byte.alias("byte"), "n", "m")).alias("grams")))
    above = lambda d: F.col("node").bitwiseAND(F.lit((1 << 8 * d) - 1))
    zeros, ones = F.col("zeros"), F.col("ones")
    own = _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - float(np.log(np.pi)) - _log_gamma(zeros + ones + 1.0)
    summed = [F.sum(c).alias(c) for c in ("zeros", "ones", "below")]
    level = contexts.mapInArrow(_deepest, "node long, zeros long, ones long, below double").groupBy("node").agg(*summed)
    levels = []
    for d in range(DEPTH - 1, -1, -1):
        high, low = F.greatest("own", "below"), F.least("own", "below")
        both = high + F.log1p(F.exp(low - high)) + float(np.log(0.5))
        level = cut(level.select("*", own.alias("own")).select("node", "zeros", "ones", both.alias("weighted")))
        levels.append(level)
        level = level.groupBy(above(d).alias("node")).agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("below"))
    down = None
    for d, level in enumerate(reversed(levels)):
        share = F.exp(own - F.col("weighted")) * 0.5
        one = (ones + 0.5) / (zeros + ones + 1.0)
        level = level.select("node", above(d).alias("up"), share.alias("share"), one.alias("one"))
        if down is None:
            level = level.withColumns({"mixed": F.lit(0.0), "left": F.lit(1.0)})
        else:
            level = level.join(down.withColumnRenamed("node", "up"), "up")
        down = level.select("node", (F.col("mixed") + F.col("left") * F.col("share") * F.col("one")).alias("mixed"), (F.col("left") * (1 - F.col("share"))).alias("left"))
    parents = down.groupBy(F.shiftrightunsigned("node", 8).alias("parent")).agg(F.collect_list(F.struct(F.col("node").bitwiseAND(F.lit(255)).alias("k"), "mixed", "left")).alias("above"))
    parent = F.col("context").bitwiseAND(F.lit((1 << 8 * (DEPTH - 1)) - 1)).alias("parent")
    return cut(contexts.select("context", "grams", parent).join(parents, "parent").select("context", "grams", "above").mapInArrow(_leaves, "key long, m long, log10 double"))


def _least(grams: DataFrame) -> int:
    """The least power of two such that at most LOOKED_UP grams occur as often."""
    often, least = 0, 1 << 62
    for r in grams.groupBy(F.floor(F.log2("m")).cast("int").alias("b")).count().orderBy(F.desc("b")).collect():
        often += r["count"]
        if often > LOOKED_UP:
            break
        least = 1 << r["b"]
    return least


def score(docs: DataFrame, fold: int = 1, folds: int = 5) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    bits_per_byte is the code length of the text in bits for each of its bytes, the end byte counted as one.
    """
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == fold, F.lit(True))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out.alias("held_out"))
    # a row goes by its content, so its name is the same when a task runs again
    rows = slim.withColumn("row", F.xxhash64("doc_id", "text"))
    training = rows.filter(~F.col("held_out"))
    counts = cut(rows.select("text", "held_out").mapInArrow(_count, "kind int, key long, n long, m long").groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("m").alias("m")))
    n_docs = training.select("doc_id").count()
    words = counts.filter(F.col("kind") == WORD).select(F.col("key").alias("token"), F.col("n").alias("c"))
    distinct, running = words.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    total, vocabulary = running + n_docs, distinct + (n_docs > 0)
    below = total + 0.5 * (vocabulary + 1)
    often_at = max(1, total * FREQUENT)
    grams = _tree(counts.filter(F.col("kind") == GRAM).select("key", "n", "m"))
    grams_at = _least(grams)

    def in_order(often: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        keys, values = (often.column(k).to_numpy() for k in (0, 1))
        order = np.argsort(keys)
        return keys[order], values[order]

    known = in_order(words.filter(F.col("c") >= often_at).toArrow())
    likely = in_order(grams.filter(F.col("m") >= grams_at).select("key", "log10").toArrow())
    held = docs.sparkSession.sparkContext.broadcast((known, likely))
    log_of = lambda c: np.log10((c + 0.5) / below)

    def looked_up(keys: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(table, keys), max(len(table) - 1, 0))
        return at, table[at] == keys if len(table) else np.zeros(len(keys), bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (tokens, times), (known_grams, logs) = held.value
        for b in sliced(batches):
            column, ids, out_of, named = b.column("text"), b.column("doc_id"), b.column("held_out"), b.column("row").to_numpy()
            data, offsets = text_bytes(column)
            for w in iter_words(column, _TABLE):
                n = w.hi - w.lo
                text, places, begins = _padded(data[offsets[w.lo] : offsets[w.hi]], offsets[w.lo : w.hi + 1] - offsets[w.lo])
                gram = _grams(text, places).view(np.int64)
                text_of = np.repeat(np.arange(n), np.diff(np.append(begins, len(places))))
                each, back = np.unique(gram, return_inverse=True)
                at, sure = looked_up(each, known_grams)
                at, sure = at[back], sure[back]
                scores = np.bincount(text_of[sure], weights=logs[at[sure]], minlength=n).astype(np.float64)
                hashed = w.hash.view(np.int64)
                doc = np.repeat(np.arange(n), np.diff(w.first))
                at, hit = looked_up(hashed, tokens)
                base = np.bincount(doc[hit], weights=log_of(times[at[hit]]), minlength=n) + log_of(n_docs)
                n_known = np.bincount(doc[hit], minlength=n) + (n_docs > 0)
                mine = named[w.lo : w.hi]
                head = pa.StructArray.from_arrays([ids.slice(w.lo, n), out_of.slice(w.lo, n), pa.array(np.diff(w.first) + 1), pa.array(n_known), pa.array(base), pa.array(scores), pa.array(np.diff(np.append(begins, len(places))))], ["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "n_bytes"])
                yield pa.RecordBatch.from_arrays([pa.array(mine), pa.array(np.full(n, WORD, np.int32)), pa.array(mine), pa.array(np.zeros(n, np.int32)), head], ["row", "kind", "token", "n", "head"])
                for kind, of, keys in ((WORD, doc[~hit], hashed[~hit]), (GRAM, text_of[~sure], gram[~sure])):
                    if len(keys):
                        yield pa.RecordBatch.from_arrays([pa.array(mine[of]), pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys), pa.array(np.ones(len(keys), np.int32)), pa.nulls(len(keys), head.type)], ["row", "kind", "token", "n", "head"])

    # the first row of a document carries its sums under a token of its own, with n = 0
    kind = "row long, kind int, token long, n int, head struct<doc_id: long, held_out: boolean, n_tokens: long, n_known: long, base: double, score: double, n_bytes: long>"
    rare = words.filter(F.col("c") < often_at).select(F.lit(WORD).alias("kind"), "token", F.log10((F.col("c") + 0.5) / below).alias("log10"))
    rare = rare.unionByName(grams.filter(F.col("m") < grams_at).select(F.lit(GRAM).alias("kind"), F.col("key").alias("token"), "log10"))
    joined = rows.mapInArrow(run, kind).join(rare, ["kind", "token"], "left")
    word, unseen = F.col("kind") == WORD, F.lit(float(np.log10(0.5 / below)))
    sums = joined.groupBy("row").agg(
        F.sum(F.when(word, F.col("n") * F.coalesce("log10", unseen)).otherwise(0.0)).alias("rare"),
        F.sum(F.when(word & F.col("log10").isNotNull(), F.col("n")).otherwise(0)).alias("rare_known"),
        F.sum(F.when(word, 0.0).otherwise(F.col("log10"))).alias("rare_grams"),
        F.max("head").alias("h"),
        F.count("head").alias("copies"),
    )
    # repeated rows have one name, their sums together
    sums = sums.withColumns({"rare": F.col("rare") / F.col("copies"), "rare_known": (F.col("rare_known") / F.col("copies")).cast("long"), "rare_grams": F.col("rare_grams") / F.col("copies"), "copy": F.explode(F.sequence(F.lit(1), F.col("copies")))})
    score_ = F.col("h.score") + F.col("rare_grams")
    return sums.select("h.doc_id", "h.held_out", "h.n_tokens", (F.col("h.n_known") + F.col("rare_known")).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), (F.col("h.base") + F.col("rare")).alias("base_score"), score_.alias("score"), (-score_ * float(np.log2(10)) / F.col("h.n_bytes")).alias("bits_per_byte"))
