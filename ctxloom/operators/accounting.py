"""Token accounting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctxloom.functions.arith import int_div
from ctxloom.functions.presets import Preset
from ctxloom.operators.offsets import named


def stats_from_totals(totals: DataFrame, preset: Preset, seqlen: int, total_row: bool = True) -> DataFrame:
    """Accounting per file, and for all files in the row with a null ``file``.

    ``totals`` is (file, docs, total). ``token_count`` follows the reported figure of the job: text
    tokens, end-of-text ids and padding, without BOS. A file without a name is an error, as it would pass for the total.
    """
    bos = F.col("docs") if preset.bos is not None else F.lit(0)
    contexts = int_div("total", seqlen) + 1
    per_file = named(totals).select(
        "file",
        F.col("docs").cast("bigint"),
        (F.col("total") - F.col("docs") - bos).cast("bigint").alias("text_tokens"),
        F.col("docs").cast("bigint").alias("eot_tokens"),
        bos.cast("bigint").alias("bos_tokens"),
        (contexts * seqlen - F.col("total")).cast("bigint").alias("pad_tokens"),
        contexts.cast("bigint").alias("contexts"),
        (contexts * seqlen - bos).cast("bigint").alias("token_count"),
    )
    if not total_row:
        return per_file
    names = per_file.columns[1:]
    return per_file.rollup("file").agg(*[F.sum(c).cast("bigint").alias(c) for c in names])


def token_stats(df: DataFrame, preset: Preset, seqlen: int, n: str = "n") -> DataFrame:
    """One row per file plus the total, from documents (file, n) with n the framed length."""
    totals = df.groupBy("file").agg(
        F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("total")
    )
    return stats_from_totals(totals, preset, seqlen)


def preset_accounting(counts: DataFrame, presets: list[Preset], seqlen: int) -> DataFrame:
    """What each preset would add to each file: special ids, padding and contexts.

    ``counts`` is (file, docs, text_tokens), one row per file; the few presets are exploded onto it.
    """
    rows = [
        F.struct(
            F.lit(p.tokenizer).alias("tokenizer"),
            F.lit(p.backend).alias("backend"),
            F.lit(p.vocab).alias("vocab"),
            F.lit(p.eot).alias("eot"),
            F.lit(p.pad).alias("pad"),
            F.lit(p.bos).cast("int").alias("bos"),
        )
        for p in presets
    ]
    wide = counts.select("file", "docs", "text_tokens", F.explode(F.array(*rows)).alias("p"))
    bos = F.when(F.col("p.bos").isNull(), F.lit(0)).otherwise(F.col("docs"))
    total = F.col("text_tokens") + F.col("docs") + bos
    contexts = int_div(total, seqlen) + 1
    return wide.select(
        "file", "p.*", contexts.alias("contexts"), (contexts * seqlen - total).alias("pad_tokens"),
        (contexts * seqlen - bos).alias("token_count"),
    )
