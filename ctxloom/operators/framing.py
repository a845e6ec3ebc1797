"""Special tokens around each document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctxloom.functions.presets import Preset


def frame_tokens(df: DataFrame, preset: Preset) -> DataFrame:
    """Append the end-of-text id; put the BOS in front where the preset has one."""
    tokens = F.concat(F.col("tokens"), F.array(F.lit(preset.eot)))
    if preset.bos is not None:
        tokens = F.concat(F.array(F.lit(preset.bos)), tokens)
    return df.withColumn("tokens", tokens)
