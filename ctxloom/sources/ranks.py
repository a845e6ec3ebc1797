"""Rank tables: lines of ``base64(token) rank``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_ranks(spark: SparkSession, path: str) -> DataFrame:
    """(token binary, rank int)"""
    parts = F.split("value", " ")
    return spark.read.text(path).select(
        F.unbase64(parts[0]).alias("token"), parts[1].cast("int").alias("rank")
    )
