"""Pre-token split and pre-token frequencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctxloom.functions.presets import PATTERNS


def pretoken_expr(text: Column, pattern: str = "neox") -> Column:
    """Array of pre-tokens. ``(?U)`` gives Unicode meaning to the character classes."""
    if pattern not in PATTERNS:
        raise ValueError(f"unknown pattern: {pattern}")
    return F.regexp_extract_all(text, F.lit("(?U)" + PATTERNS[pattern]), F.lit(0))


def pretokenize(df: DataFrame, pattern: str = "neox", text: str = "text") -> DataFrame:
    return df.withColumn("words", pretoken_expr(F.col(text), pattern))


def pretoken_counts(df: DataFrame, pattern: str = "neox", text: str = "text") -> DataFrame:
    """(word, n). Counts are combined before the shuffle, so frequent words do not make hot tasks."""
    words = df.select(F.explode(pretoken_expr(F.col(text), pattern)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
