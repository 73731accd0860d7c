"""Order-dependent maps as aggregates: the order is always a column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The row of each key that is smallest in order."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.min_by(F.struct(*rest), F.col(order)).alias("r")).select(key, "r.*")


def last_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The row of each key that is largest in order, with the place where the key was first seen."""
    rest = [c for c in rows.columns if c not in (key, order)]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("r"), F.min(order).alias("first_seen")).select(key, "r.*", "first_seen")


def top_k(rows: DataFrame, k: int, *order) -> DataFrame:
    return rows.orderBy(*order).limit(k)


def first_seen(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Each key once, with where it was first seen."""
    return rows.groupBy(key).agg(F.min(order).alias(order))


def carried(value: Column, by: Sequence[str], order: str) -> Column:
    """The last value that isn't null in the rows before this one."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))


def coming(value: Column, by: Sequence[str], order: str) -> Column:
    """The next value that isn't null in the rows behind this one."""
    return F.first(value, ignorenulls=True).over(Window.partitionBy(*by).orderBy(order).rowsBetween(1, Window.unboundedFollowing))


def batched(rows: DataFrame, by: Sequence[str], order: str, size: int) -> DataFrame:
    """rows with their number from 0 within `by`, idx, and the batch of that size they fall into."""
    idx = F.row_number().over(Window.partitionBy(*by).orderBy(order)) - 1
    return rows.withColumn("idx", idx).withColumn("batch", F.floor(F.col("idx") / size))


def either(*sets: DataFrame) -> DataFrame:
    """The rows of any of the sets, each once."""
    out = sets[0]
    for x in sets[1:]:
        out = out.unionByName(x)
    return out.distinct()


def without(rows: DataFrame, others: DataFrame) -> DataFrame:
    """The distinct rows that others lack."""
    return rows.subtract(others)
