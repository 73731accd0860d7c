"""Exact nearest neighbours by cosine, and pluggable text embedding."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import cosine

DIMENSIONS = 384


def nearest(docs: DataFrame, query: list[float], k: int, key: str = "id", vector: str = "embedding") -> DataFrame:
    """The k rows nearest to the query: cosine, score = (1 + cosine) / 2, ties by key. A top-k, not a sort of all."""
    q = F.array(*(F.lit(float(x)) for x in query))
    near = docs.withColumn("cosine", F.round(cosine(F.col(vector), q), 6)).filter(F.col("cosine").isNotNull())
    return near.withColumn("score", (1 + F.col("cosine")) / 2).orderBy(F.desc("cosine"), key).limit(k)


def hashed(texts: list[str], dimensions: int = DIMENSIONS) -> np.ndarray:
    """A deterministic stand-in for a model: signed hashes of character trigrams, scaled to length one."""
    out = np.zeros((len(texts), dimensions), np.float32)
    for i, t in enumerate(texts):
        raw = f"  {t} ".encode()
        for a in range(len(raw) - 2):
            h = int.from_bytes(raw[a : a + 3], "big") * 2654435761 % (1 << 32)
            out[i, h % dimensions] += 1 if h >> 31 else -1
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def embed(rows: DataFrame, column: str, to: str = "embedding", model: Callable[[], Callable[[list[str]], np.ndarray]] = lambda: hashed) -> DataFrame:
    """Adds vectors of a text column; model() is called once in each worker."""

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        f = model()
        for s in batches:
            yield pd.Series(list(f(s.fillna("").tolist())))

    return rows.withColumn(to, run(column))
