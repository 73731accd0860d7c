"""Session settings that the operators assume: ANSI, adaptive plans, UTC."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "lexmesh", **more: str) -> SparkSession:
    return SparkSession.builder.appName(name).config(map=SETTINGS | more).getOrCreate()
