"""A store of a classifier's answers: what was answered once isn't asked again.

Answers are kept in a keyed table by a hash of the question and its candidates; questions without an answer are kept in
a table of their own, with how often they were asked, and are asked again in the next run. Only distinct questions are
asked, and what a run got is written before it is used, so no plan asks twice.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import unused
from ..sources import keyed
from .routing import Classifier, ask, silent


def _again(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new).groupBy("key").agg(F.max("question").alias("question"), F.sum("times").alias("times"))


class Answers:
    """answered (key, question, answer) and failed (key, question, times), each a table whose merges touch new keys alone."""

    def __init__(self, path: str, answered: keyed.KeyedTable, failed: keyed.KeyedTable) -> None:
        self.path, self.answered, self.failed = path, answered, failed
        self.asked = 0  # questions of the last run

    def ask(self, rows: DataFrame, text: str, candidates: str, to: str, classifier: Classifier = silent) -> DataFrame:
        """As routing.ask, from the store and by asking what it lacks."""
        (key,) = unused(rows.columns, "question_key")
        spark = rows.sparkSession
        rows = rows.withColumn(key, F.sha2(F.to_json(F.struct(F.col(text).alias("q"), F.col(candidates).alias("c"))), 256))
        questions = rows.select(F.col(key).alias("key"), F.col(text).alias("question"), F.col(candidates).alias("candidates")).dropDuplicates(["key"])
        missing = questions.join(self.answered.read().select("key"), "key", "left_anti")
        got = f"{self.path}/runs/{uuid.uuid4().hex}"
        ask(missing, "question", "candidates", "answer", classifier).drop("candidates").write.parquet(got)
        made = spark.read.parquet(got)
        self.asked = made.count()
        good = made.filter("answer is not null")
        self.failed = self.failed.merge(good.select("key"), lambda old, new: old.join(new, "key", "left_anti"))
        self.answered = self.answered.merge(good, lambda old, new: old.unionByName(new))
        self.failed = self.failed.merge(made.filter("answer is null").select("key", "question", F.lit(1).cast("long").alias("times")), _again)
        known = self.answered.read().select(F.col("key").alias(key), F.col("answer").alias(to))
        return rows.join(known, key, "left").drop(key)


def create(spark: SparkSession, path: str) -> Answers:
    none = lambda kind: spark.createDataFrame([], kind)
    answered = keyed.create(none("key string, question string, answer string"), f"{path}/answered", "key")
    failed = keyed.create(none("key string, question string, times long"), f"{path}/failed", "key")
    return Answers(path, answered, failed)


def open_store(spark: SparkSession, path: str) -> Answers:
    return Answers(path, keyed.open_table(spark, f"{path}/answered"), keyed.open_table(spark, f"{path}/failed"))
