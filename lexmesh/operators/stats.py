"""Corpus statistics: counts of phrases and nouns, roots, buckets and coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import extract_root


def most_common(rows: DataFrame, *keys: str, limit: int | None = None) -> DataFrame:
    """Counts by key, most frequent first, ties by key."""
    out = rows.groupBy(*keys).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *keys)
    return out.limit(limit) if limit else out


def root_groups(lemmas: DataFrame) -> DataFrame:
    """From (lemma, n): (root, total, members): members, of struct(l, c), most frequent first."""
    rows = lemmas.withColumn("root", extract_root(F.col("lemma")))
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), F.col("lemma").alias("l"))))
    return rows.groupBy("root").agg(F.sum("n").alias("total"), order.alias("o")).select("root", "total", F.transform("o", lambda x: F.struct(x["l"].alias("l"), (-x["m"]).alias("c"))).alias("members"))


def bucket_shares(groups: DataFrame) -> DataFrame:
    """From (bucket, total): groups and occurrences per bucket, with their percentages."""
    rows = groups.groupBy("bucket").agg(F.count("*").alias("n_groups"), F.sum("total").alias("n_total"))
    every = Window.partitionBy()
    share = lambda c: F.round(100.0 * F.col(c) / F.sum(c).over(every), 4)
    return rows.withColumns({"pct_groups": share("n_groups"), "pct_total": share("n_total")})


def type_coverage(groups: DataFrame) -> DataFrame:
    """From (edge_type, total), null without a mapping: groups and occurrences of each type."""
    return groups.groupBy("edge_type").agg(F.count("*").alias("n_groups"), F.sum("total").alias("n_total"))


def assigned_twice(assignments: DataFrame) -> DataFrame:
    """Roots that more than one type claims."""
    return assignments.groupBy("root").agg(F.countDistinct("edge_type").alias("n")).filter("n > 1")


def group_sizes(groups: DataFrame, n: str = "n") -> DataFrame:
    """How many groups have several members, and how many one."""
    return groups.agg(F.count_if(F.col(n) > 1).alias("multi"), F.count_if(F.col(n) == 1).alias("single"))


def totals(groups: DataFrame, n: str = "n") -> DataFrame:
    """How many keys there are and what they sum up to."""
    return groups.agg(F.count("*").alias("n_keys"), F.sum(n).alias("total"))
