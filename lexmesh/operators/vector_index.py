"""A vector index: inverted lists by k-means cells, as a table partitioned by cell, for approximate and exact search.

`build` fits the cells' centres on a bounded sample, assigns every vector to the centre of the largest cosine and
writes the rows partitioned by cell, with how many rows a cell has and how far its farthest vector is from the centre.
`search` reads only the cells it needs. With `probes` those are the cells nearest to the question, which may miss hits.
Without, the answer is exact: the angle between a question and any vector of a cell is at least the angle to the centre
less that of the farthest member, so once k hits are known, every cell that can't hold a nearer one is left out.

Rows with a null vector or one of length 0 are never hits and aren't indexed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .vectors import nearest

#: Vectors that centres are fitted on at most, rounds of fitting, and cells at most.
SAMPLE, ROUNDS, MOST_CELLS = 20_000, 12, 4096
#: Cells that are looked at first, and what rounding of cosines to six digits may hide.
FIRST, ROUNDING = 4, 1e-6


@dataclass(frozen=True)
class Index:
    """What the driver holds of an index: a row for each cell, at most MOST_CELLS, whatever the number of vectors."""

    spark: SparkSession
    path: str
    cells: np.ndarray  # numbers of the cells that have rows
    centres: np.ndarray  # of length one
    sizes: np.ndarray
    angles: np.ndarray  # between the centre and the farthest member

    def rows(self, cells: np.ndarray) -> DataFrame:
        """The indexed rows of some cells; the partitions of others aren't read."""
        return self.spark.read.parquet(f"{self.path}/rows").filter(F.col("cell").isin([int(c) for c in cells]))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-300)


def fit(vectors: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centres of length one by k-means on cosines, from evenly spaced vectors; empty cells take the vectors that fit worst."""
    x = _unit(vectors)
    centres = x[np.linspace(0, len(x) - 1, cells).astype(int)].copy()
    for _ in range(rounds):
        near = x @ centres.T
        own = near.argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        empty = np.flatnonzero(np.bincount(own, minlength=cells) == 0)
        sums[empty] = x[np.argsort(near.max(axis=1), kind="stable")[: len(empty)]]
        centres = _unit(sums)
    return centres


def build(docs: DataFrame, path: str, key: str = "id", vector: str = "embedding", cells: int | None = None, sample: int = SAMPLE) -> Index:
    """Writes the index of docs to path. cells: about the square root of the rows if not given. Rows keep their columns and get `cell`."""
    spark = docs.sparkSession
    square = F.aggregate(vector, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    usable = docs.filter(square > 0)
    n = usable.count()
    # a bounded sample, the same on every run
    drawn = usable.orderBy(F.xxhash64(key), key).limit(sample).select(F.col(vector).cast("array<double>").alias("v")).toPandas()["v"]
    some = np.stack(drawn.to_numpy()) if n else np.zeros((1, 1))
    centres = spark.sparkContext.broadcast(fit(some, max(1, min(cells or round(n**0.5), MOST_CELLS, len(some)))))

    @F.pandas_udf("struct<cell: int, cosine: double>")
    def assign(vectors: pd.Series) -> pd.DataFrame:
        near = _unit(np.stack(vectors.to_numpy()).astype(np.float64)) @ centres.value.T
        return pd.DataFrame({"cell": near.argmax(axis=1).astype(np.int32), "cosine": near.max(axis=1)})

    rows = usable.withColumn("centred", assign(F.col(vector).cast("array<double>"))).withColumn("cell", F.col("centred.cell"))
    # files of one cell each; a cell of many rows is split over several
    found = []
    if n == 0:  # a file without rows, for its columns
        rows.write.mode("overwrite").parquet(f"{path}/rows")
    else:
        rows.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/rows")
        found = spark.read.parquet(f"{path}/rows").groupBy("cell").agg(F.count("*").alias("n"), F.min("centred.cosine").alias("cosine")).collect()
    about = [(r["cell"], centres.value[r["cell"]].tolist(), r["n"], r["cosine"]) for r in found]
    spark.createDataFrame(about, "cell int, centre array<double>, n long, cosine double").coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")
    return load(spark, path)


def load(spark: SparkSession, path: str) -> Index:
    """An index that was built before."""
    rows = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()
    centres = [r["centre"] for r in rows]
    of = lambda name: np.array([r[name] for r in rows], np.float64)
    return Index(spark, path, of("cell").astype(np.int64), np.array(centres), of("n"), np.arccos(np.clip(of("cosine"), -1, 1)))


def probed(index: Index, query: list[float], k: int, probes: int) -> np.ndarray:
    """The cells of the nearest centres: `probes` of them, and more until they hold k rows."""
    order = np.argsort(-(index.centres @ _unit(np.array(query, np.float64))), kind="stable")
    held = np.cumsum(index.sizes[order])
    return index.cells[order[: max(probes, int(np.searchsorted(held, k)) + 1)]]


def reachable(index: Index, query: list[float], cosine: float) -> np.ndarray:
    """The cells that may hold a vector of that cosine or a larger one."""
    angle = np.arccos(np.clip(index.centres @ _unit(np.array(query, np.float64)), -1, 1))
    return index.cells[np.cos(np.maximum(angle - index.angles, 0)) >= cosine - ROUNDING]


def search(index: Index, query: list[float], k: int, probes: int | None = None, key: str = "id", vector: str = "embedding") -> DataFrame:
    """The k rows nearest to the query, as `vectors.nearest` of the indexed rows: exactly without probes, else among the probed cells."""
    if not len(index.cells):
        return nearest(index.rows(index.cells), query, k, key, vector).drop("cell", "centred")
    first = nearest(index.rows(probed(index, query, k, probes or FIRST)), query, k, key, vector)
    if probes is None:
        cosines = [r["cosine"] for r in first.select("cosine").collect()]
        least = min(cosines) if len(cosines) == k else -1.0
        first = nearest(index.rows(reachable(index, query, least)), query, k, key, vector)
    return first.drop("cell", "centred")
