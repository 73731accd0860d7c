"""Sinks: snapshots, bucketed JSON lines, manifests and frequency files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share, below spark.checkpoint.dir; in local mode a temporary one will do."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{named or tempfile.mkdtemp(prefix='spark-')}/files-{uuid.uuid4().hex}"


def snapshot(rows: DataFrame, path: str) -> None:
    """Replaces a table. rows may not read the same path."""
    rows.write.mode("overwrite").parquet(path)


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def by_bucket(rows: DataFrame, path: str, bucket: str = "bucket") -> None:
    rows.repartition(bucket, F.pmod(F.xxhash64(*rows.columns), F.lit(16))).write.mode("overwrite").partitionBy(bucket).json(path)


def mapped_split(groups: DataFrame, mapped: str, unmapped: str) -> None:
    """Root groups with an edge type to one place of JSON lines, those without to another."""
    groups.filter("edge_type is not null").write.mode("overwrite").json(mapped)
    groups.filter("edge_type is null").drop("edge_type").write.mode("overwrite").json(unmapped)


def pairs_json(counts: DataFrame, key: str, n: str) -> DataFrame:
    """JSON lines of [key, n], most frequent first when read in the order of n, key."""
    return counts.orderBy(F.desc(n), key).select(F.to_json(F.array(F.col(key), F.col(n).cast("string"))).alias("value"))


def manifest(laws: DataFrame, path: str) -> None:
    """Laws with their files as JSON lines below path/laws, what is missing below path/missing. Each law is a line of its own."""
    found = F.col("matched_dir").isNotNull()
    laws.filter(found).select("no", "requested_name", "matched_dir", "alias_applied", "files").sort("no").write.mode("overwrite").json(f"{path}/laws")
    laws.filter(~found).select("no", "requested_name").sort("no").write.mode("overwrite").json(f"{path}/missing")


def copy_files(files: DataFrame, matched: DataFrame, path: str) -> None:
    """The files of matched laws as a table of (directory, file, raw_text), in order of both.

    A law's files lie next to each other, so a reader of one law skips the rest by the bounds of row groups. There is no folder for
    each law: their number grows with the laws, and each would be made, renamed and listed by itself.
    """
    rows = files.select(F.regexp_extract("file_path", r"([^/]+)/[^/]+$", 1).alias("directory"), F.regexp_extract("file_path", r"([^/]+)$", 1).alias("file"), "raw_text")
    own = rows.join(matched.select("directory").distinct(), "directory", "left_semi")
    own.repartitionByRange("directory", "file").sortWithinPartitions("directory", "file").write.mode("overwrite").parquet(path)
