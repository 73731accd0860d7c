"""Best-fit packing by length patterns fitted with non-negative least squares.

Documents are tokenised and cut into pieces of at most `size` tokens. Their lengths are pre-aggregated to
a histogram of at most `size` bins, and the plan is made from that alone: patterns of one to three pieces
that fill a sequence, repeat counts fitted to the histogram by non-negative least squares and rounded,
what is left packed best-fit, longest first. The plan says, for ranges of the k-th piece of a length,
which sequence and offset it takes; pieces are numbered within their length without gathering a length.

Nulls: a null text is an empty document, whose only token is the end. Repeated rows and null doc_ids are
documents of their own. Ties in length are taken in the order of the rows. An empty table gives no rows;
other columns aren't read. The plan grows with `size`, not with the documents.
"""

from __future__ import annotations

import unicodedata
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import KEPT, numbered

SIZE, END = 2048, 0
#: Middle lengths that patterns of three use, and rounds of the fit.
MIDDLES, ROUNDS = 12, 400
#: Distinct words that a worker keeps the ids of.
CACHED = 250_000

_TAIL = ".,!?;:|*$%&#"


def _byte_signs() -> list[str]:
    """The sign of each byte in byte-level vocabularies: printable Latin-1 stands for itself, others follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


_SIGNS = _byte_signs()


class WordIds:
    """Token ids of texts by their words: white space never joins two words in this kind of vocabulary."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.held: dict[str, bytes] = {"": b""}
        self.cores: dict[str, bytes] = {"": b""}

    def _core(self, core: str) -> bytes:
        """Ids of a word of letters only; a capital one, beside a sigma, is left to the tokenizer."""
        got = self.cores.get(core)
        if got is None and core != core.lower():
            got = self.cores[core] = self._whole([core])[0]
        elif got is None:
            signs = core if core.isascii() else "".join(map(_SIGNS.__getitem__, core.encode()))
            got = self.cores[core] = array("I", [t.id for t in self.model.tokenize(signs)]).tobytes()
        return got

    def _whole(self, words: list[str]) -> list[bytes]:
        """Ids of words by one call over them all, told apart by where their tokens begin."""
        got = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        starts = np.cumsum([0, *(len(w) + 1 for w in words)])
        owner = np.searchsorted(starts, np.array([a for a, _ in got.offsets], np.int64), "right") - 1
        ids, at = np.array(got.ids, "<u4"), np.searchsorted(owner, np.arange(len(words) + 1))
        return [ids[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]

    def learn(self, words: set[str]) -> None:
        """Words of letters take the merges at once, cut from closing signs; others the whole tokenizer."""
        whole = []
        held, cores, core = self.held, self.cores, self._core
        for w in words:
            low = w.rstrip(_TAIL)
            if low.isalpha() and (low.isascii() or unicodedata.is_normalized("NFC", low)):
                tail = w[len(low) :]
                if tail and tail not in cores:
                    cores[tail] = self._whole([tail])[0]
                held[w] = core(low) + cores[tail] if tail else core(low)
            else:
                whole.append(w)
        for i in range(0, len(whole), 500):
            held.update(zip(whole[i : i + 500], self._whole(whole[i : i + 500]), strict=True))

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text.

        Lower-casing is what the tokenizer does first; only a capital sigma is lowered by its place in Python.
        """
        if len(self.held) > CACHED:
            self.held, self.cores = {"": b""}, {"": b""}
        split = [(t if "\u03a3" in t else t.lower()).replace("\n", " ").split(" ") for t in (t or "" for t in texts)]
        self.learn(set().union(*split) - self.held.keys())
        get = self.held.__getitem__
        return [b"".join(map(get, s)) for s in split]


def _words(tokenizer: str) -> WordIds:
    """Those that the worker has from its tasks before, or new ones."""
    if tokenizer not in KEPT:
        KEPT[tokenizer] = WordIds(tokenizer)
    return KEPT[tokenizer]


def pieces(docs: DataFrame, tokenizer: str, size: int = SIZE) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of each piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, step = _words(tokenizer), size * 4
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                rows = []
                for d, ids in zip(part.column("doc_id").to_pylist(), words.ids(part.column("text").to_pylist()), strict=True):
                    ids += END.to_bytes(4, "little")
                    rows += [(d, i // step, i // 4, len(ids[i : i + step]) // 4, zlib.crc32(ids[i : i + step])) for i in range(0, len(ids), step)]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def patterns(counts: np.ndarray, middles: int = MIDDLES) -> np.ndarray:
    """Rows of up to three lengths, 0 for none, that fill a sequence; the middle one is a frequent length."""
    size = len(counts) - 1
    often = np.argsort(-counts[1:], kind="stable")[:middles] + 1
    often = often[counts[often] > 0]
    long = np.arange(1, size + 1)
    two = np.stack([long, size - long, np.zeros_like(long)], 1)
    three = np.array([(a, m, size - a - m) for m in often for a in range(1, size) if size - a - m >= 1], np.int64).reshape(-1, 3)
    found = np.unique(-np.sort(-np.concatenate([two, three]), axis=1), axis=0)
    return found[((counts[found] > 0) | (found == 0)).all(1)]


def fit(found: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative repeat counts x that bring A x next to the histogram: projected gradient with momentum."""
    if not len(found):
        return np.zeros(0)
    size = len(counts)
    real = (found > 0).astype(float)
    times = lambda x: np.bincount(found.ravel(), weights=(real * x[:, None]).ravel(), minlength=size)
    back = lambda r: (r[found] * real).sum(1)
    v = np.ones(len(found))
    for _ in range(20):
        v = back(times(v))
        norm = np.linalg.norm(v)
        v /= norm
    h = counts.astype(float)
    h[0] = 0
    x = y = np.zeros(len(found))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - back(times(y) - h) / (1.05 * norm))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


def plan(counts: np.ndarray, middles: int = MIDDLES) -> list[tuple[int, list[tuple[int, int]]]]:
    """(sequences, [(length, copies), ...]): how often each filling is used; together all pieces of the histogram."""
    size = len(counts) - 1
    left = counts.astype(np.int64).copy()
    left[0] = 0
    out = [(int(left[size]), [(size, 1)])] if left[size] else []
    left[size] = 0
    found = patterns(left, middles)
    x = fit(found, left)
    for k in np.argsort(-x, kind="stable"):
        lengths, copies = np.unique(found[k][found[k] > 0], return_counts=True)
        n = min(int(x[k]), int((left[lengths] // copies).min()))
        if n:
            left[lengths] -= n * copies
            out.append((n, [(int(a), int(c)) for a, c in zip(lengths[::-1], copies[::-1], strict=True)]))
    return out + best_fit(left)


def best_fit(left: np.ndarray) -> list[tuple[int, list[tuple[int, int]]]]:
    """Longest first into the smallest gap that takes it; equal pieces are placed together."""
    size = len(left) - 1
    gaps: list[int] = []
    open_: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}

    def put(gap: int, n: int, filling: list[tuple[int, int]]) -> None:
        if gap not in open_:
            open_[gap] = []
            insort(gaps, gap)
        open_[gap].append((n, filling))

    for length in range(size, 0, -1):
        todo = int(left[length])
        while todo:
            at = bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                n, filling = open_[gap].pop()
                if not open_[gap]:
                    del open_[gap], gaps[at]
            else:
                gap, n, filling = size, -(-todo // (size // length)), []
            per = gap // length
            full = min(n, todo // per)
            if full:
                put(gap - per * length, full, [*filling, (length, per)])
                todo -= full * per
            if full < n and todo and todo < per:
                put(gap - todo * length, 1, [*filling, (length, todo)])
                todo, full = 0, full + 1
            if full < n and filling:
                put(gap, n - full, filling)
    return [x for g in gaps for x in open_[g]]


def _placing(fillings: list[tuple[int, list[tuple[int, int]]]], size: int) -> dict[str, np.ndarray]:
    """Per length, ranges of piece numbers and where they go, in the order of (length, number)."""
    cursor = np.zeros(size + 1, np.int64)
    rows, sequence = [], 0
    for n, filling in fillings:
        offset = 0
        for length, copies in filling:
            rows.append((length, cursor[length], n, sequence, offset))
            cursor[length] += n * copies
            offset += length * copies
        sequence += n
    a = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "n", "sequence", "offset"), a.T, strict=True))


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    rows = numbered(pieces(docs, tokenizer, size), ["length"], "rank")
    counts = np.zeros(size + 1, np.int64)
    for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect():
        counts[r["length"]] = r["n"]
    held = docs.sparkSession.sparkContext.broadcast(_placing(plan(counts), size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = held.value
        key = (p["length"] << 44) + p["rank"]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.searchsorted(key, (length << 44) + rank, "right") - 1
            copy, more = np.divmod(rank - p["rank"][at], p["n"][at])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(p["sequence"][at] + more), pa.array(p["offset"][at] + copy * length)], [*b.schema.names[:-1], "sequence_id", "offset"])

    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
