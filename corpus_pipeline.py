"""The corpus pipeline: each stage is one of the operators over all that its predecessor kept.

All stages but the last return the columns of documents. Each is judged on its own input: rejected
documents go, repeated lines are taken out, one document of each near-duplicate group stays, and
documents with a benchmark passage go; the last one packs the tokens of the rest into sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lexmesh.llm import decontaminate, jaccard, linededup, packing, quality_pu
from lexmesh.llm.common import cut

#: The stages learn and score, so SQL can't express their rows.
ORACLE_SQL = None
#: Near-duplicate documents: five-word shingles, a similarity of 0.8 or more.
SHINGLE, PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_pu.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs, SHINGLE, PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; what a stage keeps is written to the shared checkpoint folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
