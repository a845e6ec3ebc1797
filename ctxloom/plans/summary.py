"""Run summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_summary(per_file: DataFrame, manifest: DataFrame, chunk_size: int) -> DataFrame:
    """One row: documents, tokens, contexts, shards, short shards and the share of padding.

    ``per_file`` has a row per file as given by the token accounting, without its total row.
    """
    totals = per_file.agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
            for c in ("docs", "token_count", "bos_tokens", "pad_tokens", "contexts")
        ]
    )
    shards = manifest.agg(
        F.struct(
            F.count(F.lit(1)).alias("shards"),
            F.count_if(F.col("num_sequences") < chunk_size).alias("short_shards"),
            F.coalesce(F.sum("num_sequences"), F.lit(0)).cast("bigint").alias("num_sequences"),
        )
    ).scalar()
    share = F.round(F.col("pad_tokens") / F.nullif(F.col("token_count") + F.col("bos_tokens"), F.lit(0)), 6)
    return totals.withColumn("m", shards).select("docs", "token_count", "contexts", "m.*", share.alias("pad_share"))
