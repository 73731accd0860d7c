"""Language identification by rank-order profiles.

A word is a letter and the letters and marks behind it, lower-cased; its n-grams are the runs of up to 5 characters of
the word between underscores. A language's profile is its 400 most frequent n-grams over all training texts, a
document's the same over its whole text. The out-of-place distance of a document to a language adds, for each of the
document's n-grams, how far its ranks in both profiles are apart, or 400 where the language's profile lacks it. The
language of the least distance is predicted, of equal ones the first by name. N-grams of a document that are equally
frequent share the middle of their ranks, as in short texts most are; which of them still belong to the 400 is decided
by their hashes.

N-grams go by 64-bit hashes of their characters, worked out for many texts at once. A task sums a language's counts
before they are shuffled. Only the profiles come to the driver and are broadcast, 400 numbers for each of at most
16,384 languages; more distinct values of lang are refused.

Null texts and texts without a letter are `und` with score 0, and so is every text when nothing was learned. Rows
without a doc_id have no fold: they are predicted, held out, and not learned from. Rows with a null lang are predicted
and not learned from; a lang whose texts have no letter isn't learned. Repeated rows are learned from as often as they
stand there. Empty tables give no rows; other columns aren't read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, mix64, sliced

LONGEST, PROFILE = 5, 400
LANGUAGES = 1 << 14
UNKNOWN = "und"
#: Characters that are looked at together, and n-grams that a task counts before it passes them on.
CHUNK, HELD = 1 << 18, 1 << 19

_GAP = regex.compile(r"[^\p{L}\p{M}]")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _length(n: int) -> np.uint64:
    """Tells n-grams of different lengths apart."""
    return np.uint64(n * 0xD1342543DE82EF95 % (1 << 64))


@cache
def _kinds() -> np.ndarray:
    """For each code point 1 if it is a letter, 2 if it is a mark, else 0."""
    return np.array([{"L": 1, "M": 2}.get(unicodedata.category(chr(i))[0], 0) for i in range(0x110000)], np.uint8)


def gram_hash(gram: str) -> int:
    """The hash of one n-gram, _ standing for the edge of a word."""
    h = 0
    for c in gram:
        h = (h * int(_STEP) + (1 if c == "_" else ord(c) + 1)) % (1 << 64)
    return int(mix64(np.array([h], np.uint64) + _length(len(gram)))[0])


def _counted(hashes: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes and how often each occurs, or the sums of n."""
    if n is None:
        return np.unique(hashes, return_counts=True)
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    at = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]]) if len(hashes) else np.zeros(0, np.int64)
    return hashes[at], np.add.reduceat(n[order], at) if len(at) else n[:0]


def _hashed(texts: list[str]) -> list[np.ndarray]:
    """The hashes of all n-grams of each text; texts are lower-cased."""
    code = np.frombuffer("\n".join(texts).encode("utf-32-le"), np.uint32)
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    kind, place = _kinds()[code], np.arange(len(code))
    # marks belong to a word if a letter stands before them in it
    letter = np.maximum.accumulate(np.where(kind == 1, place, -1)) if len(code) else place
    gap = np.maximum.accumulate(np.where(kind == 0, place, -1)) if len(code) else place
    word = (kind > 0) & (letter > gap)
    # words with one 0 before, between and behind them
    kept = word.copy()
    kept[1:] |= word[:-1]
    origin = np.r_[-1, place[kept], len(code)]
    stream = np.r_[0, np.where(word, code, 0)[kept], 0].astype(np.uint64)
    edge = stream == 0
    owner = np.where(edge, np.r_[origin[1:], len(code)], origin)  # an edge before a word belongs to its text
    out: list[list[np.ndarray]] = [[] for _ in texts]
    h = np.zeros(len(stream), np.uint64)
    inner = np.ones(len(stream), bool)
    for n in range(1, LONGEST + 1):
        m = len(stream) - n + 1
        if m < 1:
            break
        h = h[:m] * _STEP + stream[n - 1 :] + np.uint64(1)
        if n > 2:
            inner = inner[:m] & ~edge[n - 2 : n - 2 + m]
        good = inner[:m] & ~(edge[:m] & edge[n - 1 :]) if n < 3 else inner[:m]
        at = np.searchsorted(owner[:m][good], offsets)
        hashes = mix64(h[good] + _length(n))
        for i, o in enumerate(out):
            o.append(hashes[at[i] : at[i + 1]])
    return [np.concatenate(o) for o in out]


def _pieces(text: str) -> Iterator[str]:
    """The text lower-cased, long ones cut at gaps between words."""
    lo = 0
    while lo < len(text):
        gap = _GAP.search(text, lo + CHUNK) if lo + CHUNK < len(text) else None
        hi = gap.start() if gap else len(text)
        yield text[lo:hi].lower()
        lo = hi


def count_ngrams(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, hashes, counts) of the n-grams of each whole text, in order; without letters both are empty."""
    waiting: list[tuple[int, str]] = []
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def out() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for (i, _), h in zip(waiting, _hashed([t for _, t in waiting]), strict=True):
            yield i, *_counted(h)

    for i, text in enumerate(texts):
        pieces = list(_pieces(text.as_py() or ""))
        if len(pieces) > 1:
            parts = [_counted(_hashed([p])[0]) for p in pieces]
            yield from out()
            waiting, size = [], 0
            yield i, *_counted(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
            continue
        waiting.append((i, pieces[0] if pieces else ""))
        size += len(waiting[-1][1])
        if size > CHUNK:
            yield from out()
            waiting, size = [], 0
    yield from out()


def profiles(docs: DataFrame) -> DataFrame:
    """(lang, gram, rank) from docs (lang, text): hashes of the PROFILE most frequent n-grams of each language, ranked from 0, ties by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for lang, (grams, n) in merged().items():
                if len(grams):
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])

        def merged() -> dict[str, tuple[np.ndarray, np.ndarray]]:
            return {lang: _counted(np.concatenate([x[0] for x in some]), np.concatenate([x[1] for x in some])) for lang, some in held.items()}

        for b in sliced(batches):
            langs = b.column("lang").to_pylist()
            for i, grams, n in count_ngrams(b.column("text")):
                held.setdefault(langs[i], []).append((grams, n))
                size += len(grams)
                if size > 2 * HELD:
                    held = {lang: [x] for lang, x in merged().items()}
                    size = sum(len(x[0][0]) for x in held.values())
                    if size > HELD:
                        yield from out()
                        held, size = {}, 0
        yield from out()

    rows = docs.select("lang", "text").filter("lang is not null and text is not null")
    counted = rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranked = counted.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")) - 1)
    return ranked.filter(F.col("rank") < PROFILE).select("lang", "gram", "rank")


class Scorer:
    """Distances of texts to profiles [(lang, gram, rank)], held as rows of the n-grams that any profile has."""

    def __init__(self, rows: list[tuple[str, int, int]]) -> None:
        self.langs = sorted({r[0] for r in rows})
        at = {m: i for i, m in enumerate(self.langs)}
        grams = np.array([r[1] for r in rows], np.int64).view(np.uint64)
        order = np.argsort(grams, kind="stable")
        self.grams, first = np.unique(grams[order], return_index=True)
        self.ends = np.r_[first, len(order)]
        self.lang = np.array([at[r[0]] for r in rows], np.int64)[order]
        self.rank = np.array([r[2] for r in rows], np.float64)[order]

    def distances(self, grams: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, int]:
        """To each language, of a text with these n-grams, and how many n-grams its profile has."""
        if len(grams) > PROFILE:
            least = -np.partition(-often, PROFILE - 1)[PROFILE - 1]
            ahead, level = np.flatnonzero(often > least), np.flatnonzero(often == least)
            keep = np.r_[ahead, level[: PROFILE - len(ahead)]]  # hashes are sorted
            grams, often = grams[keep], often[keep]
        falling = np.sort(-often)
        rank = (np.searchsorted(falling, -often, "left") + np.searchsorted(falling, -often, "right") - 1) / 2
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        known = self.grams[at] == grams
        lo, n = self.ends[at[known]], self.ends[at[known] + 1] - self.ends[at[known]]
        entry = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        nearer = PROFILE - np.abs(self.rank[entry] - np.repeat(rank[known], n))
        return len(grams) * PROFILE - np.bincount(self.lang[entry], nearer, len(self.langs)), len(grams)

    def predict(self, grams: np.ndarray, often: np.ndarray) -> tuple[str, float]:
        if not self.langs or not len(grams):
            return UNKNOWN, 0.0
        distance, n = self.distances(grams, often)
        best = int(distance.argmin())
        return self.langs[best], float(1 - distance[best] / (n * PROFILE))


def predict(docs: DataFrame, learned: DataFrame) -> DataFrame:
    """docs (doc_id, held_out, text) with lang_pred and score instead of the text. score: 1 where the profiles agree, 0 where they share nothing."""
    learned = cut(learned)
    languages = learned.select("lang").distinct().count()
    if languages > LANGUAGES:
        raise ValueError(f"{languages} values of lang: profiles of more than {LANGUAGES} languages aren't broadcast")
    model = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in learned.orderBy("lang", "rank").collect()])
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for b in sliced(batches):
            made = [scorer.predict(grams, often) for _, grams, often in count_ngrams(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score; learned from the documents of the other folds."""
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == fold, F.lit(True))
    rows = docs.select("doc_id", held_out.alias("held_out"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return predict(rows, profiles(rows.filter("not held_out")))
