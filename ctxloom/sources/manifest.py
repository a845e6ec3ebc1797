"""Manifest scan and what it tells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ctxloom.operators.packing import check_positive
from ctxloom.sources.paths import decoded_path, literal

MANIFEST_NAME = "manifest.jsonl"
MANIFEST_SCHEMA = "shard string, num_sequences bigint"


def shard_stem(shard: Column) -> Column:
    return F.format_string("shard_%08d", shard)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, num_sequences)"""
    return spark.read.schema(MANIFEST_SCHEMA).json(f"{folder.rstrip('/')}/{MANIFEST_NAME}", mode="FAILFAST")


def found_manifests(spark: SparkSession, folders: list[str]) -> DataFrame:
    """(stem, members): what the manifests at any depth of the folders tell of the shards beside them.

    ``stem`` is a shard's path without its suffix. Lines that cannot be read tell nothing, and neither
    do lines that give one shard different counts.
    """
    reader = spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", "true")
    lines = reader.option("pathGlobFilter", MANIFEST_NAME).json([literal(f) for f in folders])
    folder = F.regexp_replace(decoded_path(F.col("_metadata.file_path")), "/[^/]*$", "")
    told = lines.select(F.concat_ws("/", folder, "shard").alias("stem"), F.col("num_sequences").alias("members"))
    counts = told.filter("members is not null").groupBy("stem").agg(F.min("members").alias("members"), F.max("members").alias("most"))
    return counts.filter("members = most").select("stem", "members")


def manifest_rows(assigned: DataFrame) -> DataFrame:
    """The manifest of rows with a ``shard`` column."""
    return assigned.groupBy("shard").agg(F.count(F.lit(1)).alias("num_sequences")).select(
        shard_stem(F.col("shard")).alias("shard"), "num_sequences"
    )


def manifest_tokens(manifest: DataFrame, seqlen: int) -> DataFrame:
    """One row: tokens in all shards, padding and BOS included."""
    check_positive(seqlen=seqlen)
    total = F.coalesce(F.sum("num_sequences"), F.lit(0)) * seqlen
    return manifest.agg(total.cast("bigint").alias("num_tokens"))
