"""Embedding whitening: float32 eigenvectors of the distributed covariance, refined by matrix multiplication.

Every usable vector c becomes the integers x = floor(256 * c). The mean and the covariance are taken over each
distinct x once (divisor n, centred before multiplying), so copies weigh nothing. Tasks sum d x d partial matrices
of their rows; only the sum, which d bounds whatever the number of rows, comes to the driver.

There `eigenpairs` starts from the eigenvectors in float32 and corrects them in double precision by the iteration of
Ogita and Aishima: with R = I - X'X and S = X'VX, eigenvalues are S_ii / (1 - R_ii), and X gains X E, where
E_ij = (S_ij + e_j R_ij) / (e_j - e_i), or R_ij / 2 where e_i and e_j are too close for that. Eigenvalues that lie so
close to each other make a cluster, whose vectors float32 can't tell apart: the small problem within the cluster,
shifted by its middle, is solved on its own, its vectors turn the columns, and the iteration goes on.

Null vectors, empty ones and those with null or non-finite entries are dropped; so are vectors with an entry beyond
2 ** 53 / 256, which isn't exact, and those of another length than most (of lengths as frequent, the longest stays).
Repeated ids and null ids stay rows of their own; repeated vectors count once in the fit and each get their rows.
Components without variance have a null whitened value and explained 0. Vectors with fewer entries than components
give a row for each entry. Empty tables give no rows; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Components that are returned, and what one step of an entry is worth.
COMPONENTS, SCALE = 4, 256.0
#: Rows that are multiplied at once, and rounds of refinement at most; each squares the error, so float32 needs two or three.
AT_ONCE, ROUNDS = 4096, 12
EXACT = float(1 << 53)


def scaled(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int]:
    """(key, x): x holds the integers of each usable vector as little-endian longs. Also their length, 0 if there are none."""
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    sizes = rows.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).filter("d > 0")
    most = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    d = most["d"] if most else 0

    def integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column("vector")
            flat = column.flatten()
            c = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.floor(SCALE * c)
            good = (np.abs(x) < EXACT).all(axis=1)  # false for NaN and for nulls, which are NaN here
            x = x[good].astype("<i8")
            ends = np.arange(len(x) + 1, dtype=np.int64) * (8 * d)
            packed = pa.Array.from_buffers(pa.large_binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(x)])
            yield pa.RecordBatch.from_arrays([b.column("key").filter(pa.array(good)), packed.cast(pa.binary())], ["key", "x"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.filter(F.size("vector") == d).mapInArrow(integers, f"key {kind}, x binary"), d


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """The longs of a column of packed vectors, a row each."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], "<i8", (offsets[-1] - offsets[0]) // 8, offsets[0]).reshape(-1, d) if len(column) else np.zeros((0, d), "<i8")


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """How many vectors there are and the exact sum of each entry."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, object)  # Python's integers, which don't overflow
        for b in batches:
            x = _matrix(b.column("x"), d)
            n += len(x)
            high, low = x >> 26, x & ((1 << 26) - 1)
            total += high.sum(axis=0).astype(object) * (1 << 26) + low.sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, d), pa.int32()), pa.array([n, *total], pa.decimal128(38, 0))], ["entry", "total"])

    parts = fit.mapInArrow(add, "entry int, total decimal(38,0)").groupBy("entry").agg(F.sum("total").alias("total")).collect()
    at = {r["entry"]: int(r["total"]) for r in parts}
    return at.get(-1, 0), [at.get(i, 0) for i in range(d)]


def _moments(fit: DataFrame, d: int, project, k: int) -> np.ndarray:
    """The sum of z z' over all rows, z being the k values that project makes of the vectors of a batch. k rows of k numbers come back."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for b in batches:
            x = _matrix(b.column("x"), d)
            for lo in range(0, len(x), AT_ONCE):
                z = project(x[lo : lo + AT_ONCE])
                total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["entry", "row"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for i, row in zip(b.column("entry").to_pylist(), b.column("row"), strict=True):
                row = row.values.to_numpy(zero_copy_only=False)
                held[i] = held[i] + row if i in held else row
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(list(held.values()), pa.list_(pa.float64()))], ["entry", "row"])

    kind = "entry int, row array<double>"
    out = np.zeros((k, k))
    for b in fit.mapInArrow(multiply, kind).repartition("entry").mapInArrow(add, kind).toArrow().to_batches():
        for i, row in zip(b.column("entry").to_pylist(), b.column("row"), strict=True):
            out[i] = row.values.to_numpy()
    return out


def _clusters(e: np.ndarray, gap: float) -> list[tuple[int, int]]:
    """Runs lo..hi of falling eigenvalues in which neighbours are no further apart than gap."""
    cuts = np.flatnonzero(e[:-1] - e[1:] > gap) + 1
    return list(zip(np.r_[0, cuts], np.r_[cuts, len(e)], strict=True))


def refine(v: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One round on the approximate eigenvectors x of v: better ones, the eigenvalues, and the largest correction made."""
    r = np.eye(len(v)) - x.T @ x
    s = x.T @ (v @ x)
    e = np.diag(s) / (1 - np.diag(r))
    # below this distance the division says nothing: bounded by what is off the diagonal
    near = 2 * (np.linalg.norm(s - np.diag(e)) + np.linalg.norm(v) * np.linalg.norm(r))
    apart = e[None, :] - e[:, None]
    far = np.abs(apart) > near
    fix = np.where(far, (s + e[None, :] * r) / np.where(far, apart, 1.0), r / 2)
    return x + x @ fix, e, float(np.abs(fix).max())


def eigenpairs(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues of the symmetric v and unit eigenvectors as columns, to double precision, from a float32 start."""
    size = np.abs(v).max(initial=0.0)
    if size == 0:
        return np.zeros(len(v)), np.eye(len(v))
    a = v / size
    _, x = np.linalg.eigh(a.astype(np.float32))
    x = x[:, ::-1].astype(np.float64)
    tiny = len(a) * np.finfo(np.float64).eps
    last = np.inf
    for _ in range(ROUNDS):
        x, e, most = refine(a, x)
        order = np.argsort(-e, kind="stable")
        x, e = x[:, order], e[order]
        # what float32 or the last round left off the diagonal, which says how far apart eigenvalues must be
        s = x.T @ (a @ x)
        off = np.abs(s - np.diag(np.diag(s))).max()
        for lo, hi in _clusters(e, max(1e3 * off, 1e3 * tiny)):
            if hi - lo > 1:
                base, _ = np.linalg.qr(x[:, lo:hi])
                middle = e[lo:hi].mean()
                inner = base.T @ (a @ base - middle * base)  # shifted, so that only the differences are left
                _, turn = np.linalg.eigh((inner + inner.T) / 2)
                x[:, lo:hi] = base @ turn[:, ::-1]
        # a cluster that stays together is turned anew each round, which ends the rounds as well
        if most <= 10 * tiny or most >= last and off <= 10 * tiny:
            break
        last = most
    x += x @ (np.eye(len(a)) - x.T @ x) / 2
    x /= np.linalg.norm(x, axis=0)
    e = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-e, kind="stable")
    return e[order] * size, x[:, order]


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation decimal(38,0), whitened, explained, identity_error) for each usable row and component.

    A deviation of more than 38 digits is null. identity_error is measured on the whitened vectors of the
    fit list by a pass of its own.
    """
    rows, d = scaled(vectors, key, vector)
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    n = 0
    if d:
        fit = cut(rows.select("x").distinct())
        n, sums = _sums(fit, d)
    if n == 0:
        return vectors.sparkSession.createDataFrame([], schema)
    mean = np.array([float(s // n) + (s % n) / n for s in sums])  # also where a sum is beyond a double's digits
    e, x = eigenpairs(_moments(fit, d, lambda m: m - mean, d) / n)
    k = min(components, d)
    total = float(e.sum())
    explained = np.maximum(e[:k], 0) / total if total > 0 else np.zeros(k)
    varied = explained > d * np.finfo(np.float64).eps
    turn = x[:, :k] / np.sqrt(np.where(varied, e[:k], 1.0))
    inner = _moments(fit, d, lambda m: (m - mean) @ turn, k) / n
    error = np.abs(inner - np.eye(k))[np.ix_(varied, varied)].max(initial=0.0)
    error = float(error) if varied.any() else None
    reach = max(map(abs, sums))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("x"), d)
            z = (x - mean) @ turn
            if d * (n * int(np.abs(x).max(initial=0)) + reach) ** 2 < 1 << 63:
                off = ((n * x - np.array(sums)) ** 2).sum(axis=1).tolist()
            else:
                off = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1).tolist()
                off = [o if o < 10**38 else None for o in off]
            m = len(x)
            made = [
                b.column("key").take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n)),
                pa.array(off, pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(z.ravel(), mask=np.tile(~varied, m)),
                pa.array(np.tile(explained * varied, m)),
                pa.array(np.full(m * k, np.nan if error is None else error), mask=np.full(m * k, error is None)),
            ]
            yield pa.RecordBatch.from_arrays(made, [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, schema)


def report(vectors: DataFrame) -> DataFrame:
    """whiten with the deviation as a long, null where a long doesn't hold it; deviation_exact has it then."""
    out = whiten(vectors)
    return out.withColumn("deviation_exact", F.col("deviation")).withColumn("deviation", F.expr("try_cast(deviation AS long)"))
