"""Quality classifier by positive-unlabelled learning.

A trusted positive is a training row whose label is 1; documents with their labels, if any, hidden are the
unlabelled web text. A label 0 is never read. The class prior p is estimated from scores alone (`prior_of`), and
the non-negative unbiased risk  p R+(positives) + max(0, R-(unlabelled) - p R-(positives))  is minimised over a
logistic model of binned text features. The model is fitted on a bounded sample: at most SAMPLE positives and
SAMPLE unlabelled documents outside the held-out fold, those whose hashed ids are smallest. Scoring reads every
whole text.

Features are shares and logarithms of counts over the text, each cut into BINS levels at quantiles of the
sample. Neither lang, source, doc_id nor a label is one of them.

Nulls: a null text scores as the empty one. Rows without a doc_id have no fold: they are scored, held out.
Labels of null quality or of missing documents are ignored; of several labels for a doc_id the largest
counts. Without any label, or any positive one, all texts score PRIOR. Repeated rows are scored alike, and rows of
one doc_id count once in the sample. Empty tables give no rows; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, sliced, unused

#: A bound on what is fitted on, of either kind, not on what is scored.
SAMPLE = 10_000
BINS, ROUNDS, RATE, DECAY = 16, 600, 0.05, 1e-3
PRIOR, CUTOFF = 0.85, 0.7

NAMES = ["log_words", "word_length", "capitals", "signs", "marks", "digits", "loud", "pipes", "variety", "top_word", "repeats", "line_copies", "line_words", "short_words", "not_ascii", "stops", "title_words", "loud_lines", "marked_lines", "trigram_copies"]


def describe(text: str | None) -> list[float]:
    """The features of one whole text."""
    text = text or ""
    words = text.split()
    n = max(len(words), 1)
    raw = text.encode()
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if raw else np.zeros(256, np.int64)
    chars = max(len(raw) - int(count[[9, 10, 11, 12, 13, 32]].sum()), 1)
    of = lambda signs: float(count[list(signs.encode())].sum())
    freq: dict[str, int] = {}
    for w in words:
        freq[w] = freq.get(w, 0) + 1
    lines = [x for x in text.split("\n") if x.strip()]
    m = max(len(lines), 1)
    pairs = list(zip(words, words[1:], words[2:], strict=False))
    letters = float(count[65:91].sum() + count[97:123].sum())
    return [
        np.log1p(len(words)),
        sum(map(len, words)) / n,
        float(count[65:91].sum()) / max(letters, 1),
        of("#*$%&<>") / chars,
        of(".,;:!?") / n,
        float(count[48:58].sum()) / chars,
        of("!?") / n,
        of("|") / n,
        len(freq) / n,
        max(freq.values(), default=0) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        1 - len(set(lines)) / m if lines else 0.0,
        np.log1p(n / m),
        sum(len(w) < 4 for w in words) / n,
        float(count[128:].sum()) / chars,
        of(".") / n,
        sum(w[:1].isupper() for w in words) / n,
        sum("!!" in x for x in lines) / m,
        sum("|" in x or "$$" in x or "##" in x or "%%" in x for x in lines) / m,
        1 - len(set(pairs)) / max(len(pairs), 1) if pairs else 0.0,
    ]


class Model:
    """Cuts of the features and weights of their levels."""

    def __init__(self, cuts: list[np.ndarray], weights: np.ndarray, bias: float):
        self.cuts, self.weights, self.bias, self.prior = cuts, weights, bias, PRIOR

    def levels(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], "right") + j * BINS for j, c in enumerate(self.cuts)], 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weights[self.levels(x)].sum(1) + self.bias, -30, 30)))


def risk(theta: np.ndarray, positives: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, np.ndarray]:
    """The non-negative risk of weights and bias theta over rows of levels, and the direction that is descended.

    Where the part of the negatives is below zero the direction climbs out of it, as the method has it.
    """
    f, u = theta[positives].sum(1) + theta[-1], theta[unlabelled].sum(1) + theta[-1]
    s, t = (1 / (1 + np.exp(-np.clip(x, -30, 30))) for x in (f, u))
    # sigmoid loss: of a positive 1 - s, of a negative s, both of slope s (1 - s). It is bounded, so a prior that is
    # somewhat too high doesn't put the risk of the negatives below zero for long
    negative = t.mean() - prior * s.mean()
    sign = 1 if negative >= 0 else -1
    slope_p = -prior * s * (1 - s) / len(f) * (2 if sign > 0 else -1)
    slope_u = sign * t * (1 - t) / len(u)
    total = prior * (1 - s).mean() + max(0.0, negative)
    g = np.zeros_like(theta)
    for levels, slope in ((positives, slope_p), (unlabelled, slope_u)):
        g[:-1] += np.bincount(levels.ravel(), weights=np.repeat(slope, levels.shape[1]), minlength=len(theta) - 1)
    g[-1] = slope_p.sum() + slope_u.sum()
    return total, g


def _descend(theta: np.ndarray, rounds: int, gradient) -> np.ndarray:
    """Full-batch Adam with a falling rate and decay of the weights."""
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        g = gradient(theta)
        g[:-1] += DECAY * theta[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - RATE * (1 - t / (rounds + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return theta


def prior_of(positives: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among the unlabelled, from the scores of both by a model that tells the two kinds apart.

    Above any cut the unlabelled hold at least the prior times the share of the positives there, so the prior is at
    most the quotient. The least quotient is taken, over cuts that hold half of the positives or more. Noise makes
    it too low rather than too high.
    """
    cuts = np.unique(np.quantile(positives, np.linspace(0, 0.5, 101)))
    p, u = (1 - np.searchsorted(np.sort(x), cuts) / len(x) for x in (positives, unlabelled))
    return float(np.clip((u / p).min(), 0.01, 0.99))


def fit(positives: np.ndarray, unlabelled: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Minimises the non-negative risk over the features of both; without either all texts score PRIOR."""
    if not len(positives) or not len(unlabelled):
        return Model([np.zeros(0)] * len(NAMES), np.zeros(len(NAMES) * BINS), float(np.log(PRIOR / (1 - PRIOR))))
    # the tails, where bad texts are, are cut finer than the middle
    cuts = [np.unique(np.quantile(unlabelled[:, j], [0.01, 0.03, 0.06, 0.1, 0.2, 0.4, 0.6, 0.8, 0.85, 0.88, 0.9, 0.92, 0.94, 0.97, 0.99])) for j in range(unlabelled.shape[1])]
    model = Model(cuts, np.zeros(len(cuts) * BINS), 0.0)
    p, u = model.levels(positives), model.levels(unlabelled)
    start = np.zeros(len(cuts) * BINS + 1)

    def apart(theta: np.ndarray) -> np.ndarray:
        """Of one half: positives against unlabelled, both with the weight of a half."""
        g = np.zeros_like(theta)
        for levels, is_p in ((p[::2], 1), (u[::2], 0)):
            slope = (1 / (1 + np.exp(-np.clip(theta[levels].sum(1) + theta[-1], -30, 30))) - is_p) / (2 * len(levels))
            g[:-1] += np.bincount(levels.ravel(), weights=np.repeat(slope, levels.shape[1]), minlength=len(theta) - 1)
            g[-1] += slope.sum()
        return g

    # the other half of both kinds names the prior
    theta = _descend(start.copy(), rounds // 3, apart)
    prior = prior_of(theta[p[1::2] if len(p) > 1 else p].sum(1), theta[u[1::2] if len(u) > 1 else u].sum(1))
    start[-1] = np.log(prior / (1 - prior))
    theta = _descend(start, rounds, lambda x: risk(x, p, u, prior)[1])
    model.weights, model.bias, model.prior = theta[:-1], float(theta[-1]), prior
    return model


def fold(modulus: int = 4):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(modulus))


def train(docs: DataFrame, labels: DataFrame, held: int = 2, sample: int = SAMPLE) -> Model:
    """Fits on at most `sample` positives and `sample` unlabelled documents; their texts are described where they lie."""
    trusted = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct().filter(fold() != held)
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null").distinct().filter(fold() != held)
    some = lambda ids, salt, kind: ids.orderBy(F.xxhash64("doc_id", F.lit(salt)), "doc_id").limit(sample).withColumn("kind", F.lit(kind))
    chosen = cut(some(trusted, 1, 1).unionByName(some(every, 2, 0)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("kind"), pa.array([describe(t) for t in b.column("text").to_pylist()], pa.list_(pa.float64()))], ["doc_id", "kind", "x"])

    found = rows.select("doc_id", "kind", "text").mapInArrow(run, "doc_id long, kind int, x array<double>")
    got = found.groupBy("doc_id", "kind").agg(F.min("x").alias("x")).toPandas().sort_values(["kind", "doc_id"], kind="stable")
    of = lambda kind: np.array(got["x"][got["kind"] == kind].tolist(), float).reshape(-1, len(NAMES))
    return fit(of(1), of(0))


def score(docs: DataFrame, model: Model, cutoff: float = CUTOFF) -> DataFrame:
    """All columns of docs with score and predicted; columns of docs by such a name, in any case, are kept and the new ones get an underscore before theirs."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    more = unused(docs.columns, "score", "predicted")
    names = [*docs.columns, *more]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            s = held.value.score(np.array([describe(t) for t in b.column("text").to_pylist()]).reshape(-1, len(NAMES)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s), pa.array((s >= cutoff).astype(np.int32))], names)

    return docs.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), f"`{more[0]}` double, `{more[1]}` int"]))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    out = score(docs.select("doc_id", F.col("text").cast("string").alias("text")), train(docs, labels))
    return out.select("doc_id", F.coalesce(fold() == 2, F.lit(True)).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """The documents that aren't rejected, with the columns they came with."""
    held = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            x = np.array([describe(t) for t in b.column("text").to_pylist()]).reshape(-1, len(NAMES))
            yield b.filter(pa.array(held.value.score(x) >= cutoff))

    return docs.mapInArrow(run, docs.schema)
