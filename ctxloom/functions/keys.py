"""Seeded shuffle keys and what is derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Hex digits of the key that name its bucket: 65,536 buckets, however large the data.
BUCKET_DIGITS = 4


def key_expr(seed: int, *parts: str | Column) -> Column:
    """md5 of (seed, parts): the same order on any cluster and under any partitioning."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols]))


def shuffle_key(df: DataFrame, seed: int, ids: tuple[str, ...] = ("file", "ctx")) -> DataFrame:
    return df.withColumn("key", key_expr(seed, *ids))


def bucket_expr(key: str = "key") -> Column:
    """Key prefix; bucket order is key order, so ranks are bucket base + rank in bucket."""
    return F.substring(F.col(key), 1, BUCKET_DIGITS)


def cell_expr(n_cells: int, key: str = "key", start: int = 1) -> Column:
    """Uniform cell number from eight hex digits of the key."""
    return F.pmod(F.conv(F.substring(F.col(key), start, 8), 16, 10).cast("bigint"), F.lit(n_cells))


def assign_cells(df: DataFrame, n_cells: int, seed: int, ids: tuple[str, ...] = ("file", "ctx")) -> DataFrame:
    if n_cells < 1:
        raise ValueError("n_cells must be at least 1")
    return shuffle_key(df, seed, ids).withColumn("cell", cell_expr(n_cells))
