"""Tables bucketed by key whose merges rewrite the buckets with new rows alone.

A table is a folder: data/version=v/bucket=b holds a bucket as of version v, and pointers/version=v says for each bucket
which version holds it. A merge reads the buckets that incoming keys fall into, writes what becomes of them as a new
version, and writes the pointers last, as one file: a run that fails before leaves the version before it, and readers
never see half a merge. Other buckets' files stay as they are. One writer at a time is assumed.

Rows that are only added, as what is there stays, are written beside it: a pointer also names the versions that added to a bucket.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
#: Rows whose keys are compared at once where rows are added, and rounds at most: each reads the incoming rows again, and has its share of them on disk.
ROUND_ROWS, MOST_ROUNDS = 5_000_000, 3
_POINTERS = "version long, bucket int, held_by long, keys array<string>, buckets int, columns string, added array<long>"


@dataclass(frozen=True)
class KeyedTable:
    """A table at one version. Its pointers are a row for each bucket, whatever the number of rows."""

    spark: SparkSession
    path: str
    version: int
    keys: tuple[str, ...]
    buckets: int
    columns: str  # schema of the rows
    held_by: dict[int, int]  # the version of each bucket that has rows
    added: dict[int, tuple[int, ...]] = field(default_factory=dict)  # later versions with more rows of it

    def read(self, of: set[int] | None = None) -> DataFrame:
        """The rows, of some buckets alone if they are named."""
        paths = [f"{self.path}/data/version={v}/bucket={b}" for b, first in sorted(self.held_by.items()) if of is None or b in of for v in (first, *self.added.get(b, ()))]
        return self.spark.read.schema(self.columns).parquet(*paths) if paths else self.spark.createDataFrame([], self.columns)

    def place(self) -> Column:
        return _place(self.keys, self.buckets)

    def merge(self, incoming: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> KeyedTable:
        """The table after combine(old rows, incoming), which is given the buckets that incoming falls into and keeps their keys there."""
        touched = {r[0] for r in incoming.select(self.place()).distinct().collect()}  # at most as many as there are buckets
        if not touched:
            return self
        return _write(self.spark, combine(self.read(touched), incoming), self, touched)

    def add(self, incoming: DataFrame) -> KeyedTable:
        """The table with the incoming rows whose keys it lacks, one of each key; its own rows are neither rewritten nor moved but for their keys."""
        version, written = self.version + 1, set()
        rounds = max(1, min(MOST_ROUNDS, (incoming.count() + self.read().count()) // ROUND_ROWS))
        for k in range(rounds):
            fresh = self._fresh(incoming, {b for b in range(self.buckets) if b % rounds == k})
            written |= _put(fresh, self, version, "append" if k else "overwrite")
            del fresh
            _tidy(self.spark)
        if not written:
            return self
        more = {b: (*self.added.get(b, ()), version) for b in written if b in self.held_by}
        return _point(self, version, dict.fromkeys(written, version) | self.held_by, self.added | more)

    def _fresh(self, incoming: DataFrame, of: set[int]) -> DataFrame:
        """The incoming rows, with their bucket, of some buckets and of keys that those lack, one of each key."""
        rows = self.read(of)
        rest = F.struct(*(c for c in rows.columns if c not in self.keys)) if len(rows.columns) > len(self.keys) else F.lit(True)
        new = incoming.select(self.place().alias("bucket"), *self.keys, rest.alias("row"), F.lit(False).alias("known")).filter(F.col("bucket").isin(of))
        old = rows.select(self.place().alias("bucket"), *self.keys, F.lit(None).cast(new.schema["row"].dataType).alias("row"), F.lit(True).alias("known"))
        # dealt by bucket as the files are, so this is the only exchange; an anti join would go below the unions that incoming is made of
        each = new.unionByName(old).repartition("bucket").groupBy("bucket", *self.keys).agg(F.max("known").alias("known"), F.first("row", ignorenulls=True).alias("row"))
        return each.filter("not known").select("bucket", *(F.col(c) if c in self.keys else F.col("row")[c].alias(c) for c in rows.columns))


def _tidy(spark: SparkSession) -> None:
    """Has the driver collect its garbage, upon which Spark removes the shuffle files of a write that is done."""
    spark.sparkContext._jvm.System.gc()


def _place(keys: tuple[str, ...], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _write(spark: SparkSession, rows: DataFrame, before: KeyedTable, touched: set[int] | None) -> KeyedTable:
    version = before.version + 1
    if "bucket" in {c.lower() for c in rows.columns}:
        raise ValueError("a keyed table has no column named bucket of its own")
    written = _put(rows.withColumn("bucket", before.place()).repartition("bucket"), before, version)
    if touched is not None and not written <= touched:
        raise ValueError("combine gave rows of other keys than the incoming ones")
    left = lambda x: {b: v for b, v in x.items() if touched is not None and b not in touched}
    return _point(before, version, left(before.held_by) | dict.fromkeys(written, version), left(before.added))


def _put(rows: DataFrame, table: KeyedTable, version: int, mode: str = "overwrite") -> set[int]:
    """Writes rows with their bucket as the data of a version; the buckets that have some. In order of their keys they take less room."""
    out = f"{table.path}/data/version={version}"
    rows.sortWithinPartitions("bucket", *table.keys).write.mode(mode).option("compression", "zstd").partitionBy("bucket").parquet(out)
    return {r[0] for r in table.spark.read.schema("bucket int").parquet(out).select("bucket").distinct().collect()}


def _point(before: KeyedTable, version: int, held_by: dict[int, int], added: dict[int, tuple[int, ...]]) -> KeyedTable:
    pointers = [(version, b, held_by.get(b), list(before.keys), before.buckets, before.columns, list(added.get(b, ()))) for b in range(before.buckets)]
    before.spark.createDataFrame(pointers, _POINTERS).coalesce(1).write.mode("overwrite").json(f"{before.path}/pointers/{version}")
    return KeyedTable(before.spark, before.path, version, before.keys, before.buckets, before.columns, held_by, added)


def create(rows: DataFrame, path: str, *keys: str, buckets: int = BUCKETS) -> KeyedTable:
    """Writes rows as the first version of a table at a new path."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    table = _write(rows.sparkSession, rows, KeyedTable(rows.sparkSession, path, -1, keys, buckets, columns, {}), None)
    _tidy(rows.sparkSession)
    return table


def open_table(spark: SparkSession, path: str, version: int | None = None) -> KeyedTable:
    """The table at its last version, or at an earlier one."""
    rows = spark.read.schema(_POINTERS).json(f"{path}/pointers/*")
    last = version if version is not None else rows.agg(F.max("version")).first()[0]
    found = rows.filter(F.col("version") == last).collect()
    if not found:
        raise ValueError(f"{path} has no version {last}")
    held_by = {r.bucket: r.held_by for r in found if r.held_by is not None}
    added = {r.bucket: tuple(r.added) for r in found if r.added}
    return KeyedTable(spark, path, last, tuple(found[0]["keys"]), found[0]["buckets"], found[0]["columns"], held_by, added)
