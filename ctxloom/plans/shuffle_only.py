"""The shuffle-only job: reshuffle ready contexts without decoding them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ctxloom.functions.keys import key_expr
from ctxloom.functions.presets import NEOX
from ctxloom.operators.packing import check_positive
from ctxloom.plans.common import JobResult, Placement, finish_job, place_rows
from ctxloom.runtime import scratch_path, store
from ctxloom.sinks.shard_tar import check_unused, write_shards
from ctxloom.sources.listing import resolve_inputs
from ctxloom.sources.paths import qualified, relative_name
from ctxloom.sources.shards import TAR_SUFFIX, count_shards, read_ranges


def member_shards(
    members: DataFrame, counts: DataFrame, chunk_size: int, seed: int, shuffle: str = "global", n_cells: int = 128
) -> Placement:
    """Members (file, ctx, name, payload) with their shards.

    ``counts`` (file, contexts) decides where each member goes, so a payload moves once.
    """
    contexts = counts.agg(F.coalesce(F.sum("contexts"), F.lit(0))).first()[0]
    keyed = members.select(key_expr(seed, "file", "ctx").alias("key"), "name", "payload")
    placed, order = place_rows(keyed, counts, contexts, chunk_size, seed, shuffle, n_cells)
    return Placement(placed, (order,), -(-contexts // chunk_size))


def shuffle_shards(
    spark: SparkSession,
    inputs: list[str] | str,
    output: str,
    seqlen: int = 2049,
    chunk_size: int = 8192,
    seed: int = 1234,
    ext: str | None = None,
    shuffle: str = "global",
    n_cells: int = 128,
    tokenizer: str = NEOX,
    input_json: str | None = None,
    output_json: str | None = None,
    work: str | None = None,
) -> JobResult:
    """Shard tars to reshuffled shard tars. ``seqlen`` only serves the token count of the card.

    Tokens are not counted, as contexts stay closed: ``token_count`` is 0 in the summary. A tar that the
    manifest beside it counts is read once; a count that is wrong stops the job.
    """
    check_positive(seqlen=seqlen, chunk_size=chunk_size, n_cells=n_cells)
    ext = ext or TAR_SUFFIX
    check_unused(qualified(spark, output))
    parent = resolve_inputs(spark, inputs, ext).parent
    work = qualified(spark, work or scratch_path(spark, "shuffle"))
    ranges = store(count_shards(spark, inputs, ext), f"{work}/ranges")
    counts = ranges.groupBy(relative_name("src", parent).alias("file")).agg(F.sum("members").alias("contexts"))
    counts = store(counts, f"{work}/files")
    members = read_ranges(ranges).select(
        relative_name("src", parent).alias("file"), F.col("pos").alias("ctx"), "name", "payload"
    )
    placed = member_shards(members, counts, chunk_size, seed, shuffle, n_cells)
    write_shards(placed.rows, output, placed.order, placed.shards)
    zero = F.lit(0).cast("bigint")
    closed = counts.select("contexts", *[zero.alias(c) for c in ("docs", "token_count", "bos_tokens", "pad_tokens")])
    result = finish_job(spark, output, closed, chunk_size, seqlen, tokenizer, input_json, output_json)
    result.work = work
    return result
