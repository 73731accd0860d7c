"""Incremental loading of documents: an extension beside the batch build."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import stable_id


def documents(spark: SparkSession, path: str, schema: str, per_trigger: int = 1000) -> DataFrame:
    """Files of a folder as they come, with stable ids."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)
    return rows.withColumn("id", stable_id(F.lit("document"), F.col("file_path")))


def once(rows: DataFrame, time: str, lateness: str = "1 hour") -> DataFrame:
    """Each id once within the lateness."""
    return rows.withWatermark(time, lateness).dropDuplicatesWithinWatermark(["id"])


def into(rows: DataFrame, table: str, checkpoint: str):
    """Appends each batch to a Parquet folder; a batch that runs again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={number}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
