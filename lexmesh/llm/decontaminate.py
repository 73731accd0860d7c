"""Benchmark decontamination: one Aho-Corasick automaton over normalised questions and answers.

Texts are normalised once: A-Z lower-cased, words `[0-9a-z and all non-ASCII]+` joined by single
spaces. A window is `window` consecutive item words; a shorter item, unless it has none, is one
window. The automaton runs over the normalised text once and each match is mapped to the words, and
so to the characters, of the original text.

Nulls: a null text has no words, and neither does a null item. Windows of items without an id mark
words, but are no item. Repeated rows are scanned as rows of their own; equal item_ids count once.
An empty benchmark marks nothing. Columns that aren't named below are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NOT_ALNUM, ascii_lower, byte_table, cut, sliced, split_words

WINDOW = 10
#: Bytes of windows in one automaton, which takes about 45 times as much in a worker. More windows are scanned for in further passes.
BLOCK_BYTES = 8 << 20

_TABLE = byte_table(NOT_ALNUM, lower=True)
_TABLE[_TABLE == 0] = 32
_MAP = _TABLE.tobytes()
_BUILT: dict = {}

SCHEMA = "doc_id long, n_words long, hits array<struct<first: long, last: long, start: long, end: long>>, items array<string>"


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(window, items): each distinct window with the item_ids, as strings, that hold it."""
    words = items.select(F.col("item_id").cast("string").alias("item"), split_words(ascii_lower(F.col("text")), NOT_ALNUM).alias("w")).filter(F.size("w") > 0)
    each = F.transform(F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0))), lambda i: F.array_join(F.slice("w", i + 1, size), " "))
    return words.select("item", F.explode(F.array_distinct(each)).alias("window")).groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _automaton(block: list[tuple[str, list[str]]]):
    """Built once per worker and block. Windows are kept as text of one character per UTF-8 byte."""
    if _BUILT.get("block") is not block:
        a = ahocorasick.Automaton()
        for k, (w, _) in enumerate(block):
            a.add_word(f" {w.encode().decode('latin-1')} ", k)
        if block:
            a.make_automaton()
        _BUILT.update(block=block, automaton=a)
    return _BUILT["automaton"]


def _spans(starts: np.ndarray, lengths: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of the merged matches; a match begins and ends with the space beside a word."""
    first = np.searchsorted(starts, ends - lengths + 1)
    last = np.searchsorted(starts, ends) - 1
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    cut = np.flatnonzero(np.r_[True, first[1:] > last[:-1] + 1])
    return first[cut], np.r_[last[cut[1:] - 1], last[-1]]


def scan_text(text: str | None, automaton, block) -> tuple[int, list[dict], list[str]]:
    """Words, merged hit spans (word and character places) and items of one text."""
    raw = (text or "").encode()
    words = raw.translate(_MAP).split()
    if not words or not block:
        return len(words), [], []
    flat = b" " + b" ".join(words) + b" "
    found = list(automaton.iter(flat.decode("latin-1")))
    if not found:
        return len(words), [], []
    ends = np.array([e for e, _ in found])
    lengths = np.array([len(block[k][0].encode()) + 2 for _, k in found])
    b = np.frombuffer(flat, np.uint8)
    first, last = _spans(np.flatnonzero(b == 32), lengths, ends)
    o = np.frombuffer(raw, np.uint8)
    word = _TABLE[o] != 32
    at = np.flatnonzero(word & ~np.r_[False, word[:-1]])
    to = np.flatnonzero(word & ~np.r_[word[1:], False]) + 1
    chars = np.r_[0, np.cumsum((o & 0xC0) != 0x80)]
    hits = [{"first": int(f), "last": int(z), "start": int(chars[at[f]]), "end": int(chars[to[z]])} for f, z in zip(first, last, strict=True)]
    return len(words), hits, sorted({x for _, k in found for x in block[k][1]})


def scan(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, hits (merged spans of words and of characters), items.

    Windows are dealt to blocks of at most block_bytes, so that what the driver and a task hold is bounded;
    a block costs a pass over the documents. Rows get a key of their own before several passes, by which
    these are merged.
    """
    spark = docs.sparkSession
    rows = docs.select(F.lit(None).cast("long").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    passes: list[DataFrame] = []
    block: list[tuple[str, list[str]]] = []
    size = 0
    for r in windows(items, window).toLocalIterator():
        size += len(r["window"].encode())
        if size > block_bytes and block:
            if not passes:
                rows = cut(rows.withColumn("row", F.monotonically_increasing_id()))
            passes.append(_pass(rows, spark.sparkContext.broadcast(block)))
            block, size = [], len(r["window"].encode())
        block.append((r["window"], list(r["items"])))
    passes.append(_pass(rows, spark.sparkContext.broadcast(block)))
    return passes[0].drop("row") if len(passes) == 1 else _merged(passes)


def _pass(rows: DataFrame, held) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = held.value
        automaton = _automaton(block)
        for b in sliced(batches):
            out = [scan_text(t, automaton, block) for t in b.column("text").to_pylist()]
            kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("first", "last", "start", "end")]))
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], kind), pa.array([x[2] for x in out], pa.list_(pa.string()))], ["row", "doc_id", "n_words", "hits", "items"])

    return rows.mapInArrow(run, f"row long, {SCHEMA}")


def _merged(passes: list[DataFrame]) -> DataFrame:
    """Joins the passes over blocks by row: spans of a row are merged again, items united."""
    rows = passes[0]
    for p in passes[1:]:
        rows = rows.unionByName(p)
    later = lambda acc, x: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["last"] + 1 >= x["first"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["first"].alias("first"), F.greatest(F.element_at(acc, -1)["last"], x["last"]).alias("last"), F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end")))),
    ).otherwise(F.concat(acc, F.array(x)))
    all_hits = F.array_sort(F.flatten(F.collect_list("hits")))
    empty = F.array().cast("array<struct<first: long, last: long, start: long, end: long>>")
    return rows.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), all_hits.alias("h"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")).select("doc_id", "n_words", F.aggregate("h", empty, later).alias("hits"), "items")


def report(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The digest columns of the query."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x["last"] - x["first"] + 1)
    return scan(docs, items, window).select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256")).withColumn("contaminated", F.col("n_hit") > 0)


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any hit word, with all their columns, rows without an id included.

    The scan runs beside the columns of the row, so nothing is joined back.
    """
    spark = docs.sparkSession
    found = windows(items, window)
    kept = docs
    block: list[tuple[str, list[str]]] = []
    size = 0
    for r in found.toLocalIterator():
        size += len(r["window"].encode())
        if size > BLOCK_BYTES and block:
            kept = cut(_without(kept, spark.sparkContext.broadcast(block)))  # so that one automaton at a time is in a worker
            block, size = [], len(r["window"].encode())
        block.append((r["window"], list(r["items"])))
    return _without(kept, spark.sparkContext.broadcast(block)) if block else kept


def _without(docs: DataFrame, held) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = held.value
        automaton = _automaton(block)
        for b in sliced(batches):
            keep = [not scan_text(t, automaton, block)[1] for t in b.column("text").to_pylist()]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
