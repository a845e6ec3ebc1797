"""What both jobs share."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ctxloom.operators.cascade import cascade_shards
from ctxloom.operators.shuffle import enumerate_contexts, locate_shards, lookup_bytes, shard_lookup
from ctxloom.plans.card import finalize_card
from ctxloom.plans.summary import run_summary
from ctxloom.sources.manifest import read_manifest

# Lookup tables above this size are joined, not broadcast.
BROADCAST_LIMIT = 256 << 20
# A 32-digit key, two numbers and the row around them.
_PLACE_BYTES = 112


@dataclass
class JobResult:
    """What a job reports. ``card`` is None when no card was asked for."""

    summary: dict
    card: dict | None = None
    warnings: list[str] = field(default_factory=list)
    rejects: int = 0
    work: str = ""


@dataclass(frozen=True)
class Placement:
    """Rows for the shard sink, the order of a shard's rows, and the number of full and short shards."""

    rows: DataFrame
    order: tuple[str, ...]
    shards: int


def place_rows(
    keyed: DataFrame, counts: DataFrame, contexts: int, chunk_size: int, seed: int, shuffle: str, n_cells: int
) -> tuple[DataFrame, str]:
    """Rows with a ``key`` get their ``shard``; also the column that orders a shard's contexts.

    ``counts`` (file, contexts) is all that placing needs. A small enough table of places is
    broadcast, so the rows stay where they are; a larger one is joined on the uniform key.
    """
    if shuffle == "global":
        lookup = shard_lookup(counts, seed, chunk_size)
        return locate_shards(keyed, lookup, lookup_bytes(contexts, chunk_size) <= BROADCAST_LIMIT), "key"
    if shuffle != "cells":
        raise ValueError(f"unknown shuffle: {shuffle}")
    places = cascade_shards(enumerate_contexts(counts), n_cells, chunk_size, seed).select("key", "shard", "idx")
    small = contexts * _PLACE_BYTES <= BROADCAST_LIMIT
    return keyed.join(F.broadcast(places) if small else places, "key"), "idx"


def finish_job(
    spark: SparkSession, output: str, per_file: DataFrame, chunk_size: int, seqlen: int, tokenizer: str,
    input_json: str | None, output_json: str | None,
) -> JobResult:
    summary = run_summary(per_file, read_manifest(spark, output), chunk_size).first().asDict()
    if summary["num_sequences"] != summary["contexts"]:
        raise RuntimeError(f"{summary['num_sequences']} contexts written, {summary['contexts']} expected")
    card, warnings = finalize_card(spark, input_json, output_json, output, seqlen, tokenizer)
    return JobResult(summary, card, warnings)
