"""The tokenize-and-shuffle job.

Tokens are written once as block streams and cross the network once, on their way to their shard.
Everything in between works on counts and keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ctxloom.functions.arith import int_div
from ctxloom.functions.keys import key_expr
from ctxloom.functions.presets import NEOX, Preset, preset
from ctxloom.operators.accounting import stats_from_totals
from ctxloom.operators.encode import Vocab
from ctxloom.operators.packing import check_positive, pad_pieces
from ctxloom.operators.streams import arrange_blocks, block_streams, block_totals, split_rejects, stream_pieces
from ctxloom.plans import common
from ctxloom.plans.common import JobResult, Placement, finish_job, place_rows
from ctxloom.runtime import scratch_path, store
from ctxloom.sinks.shard_tar import check_unused, write_shards
from ctxloom.sources.documents import check_records, documents_of, read_lines
from ctxloom.sources.listing import resolve_inputs, scanned_files
from ctxloom.sources.paths import COMPRESSED, qualified, relative_name

MEMBER_SUFFIX = ".json.gz"


def encode_stage(
    docs: DataFrame, encoder: Vocab | Callable[[Column], Column], rules: Preset, seqlen: int, path: str
) -> DataFrame:
    """Encode documents into block streams and store them, the one costly intermediate.

    The stored table cuts the lineage: a lost executor never means encoding twice.
    """
    if isinstance(encoder, Vocab):
        streams = block_streams(docs, rules, seqlen, encoder)
    else:
        streams = block_streams(docs.withColumn("tokens", encoder(F.col("text"))), rules, seqlen)
    return store(streams, path)


def account_stage(
    streams: DataFrame, rules: Preset, seqlen: int, work: str, files: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(totals per block, accounting per file), stored: small tables that several later steps read."""
    totals = store(block_totals(streams), f"{work}/totals")
    by_file = totals.groupBy("file").agg(F.sum("docs").alias("docs"), F.sum("total").alias("total"))
    if files is not None:
        by_file = files.join(by_file, "file", "left")
    by_file = by_file.select("file", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("docs", "total")])
    stats = stats_from_totals(by_file, rules, seqlen, total_row=False)
    total = (F.col("contexts") * seqlen - F.col("pad_tokens")).alias("total")
    return totals, store(stats.select("*", total), f"{work}/files")


def shard_pieces(
    streams: DataFrame, totals: DataFrame, per_file: DataFrame, rules: Preset, seqlen: int, chunk_size: int,
    seed: int, shuffle: str = "global", n_cells: int = 128,
) -> Placement:
    """Pieces of contexts, each with its shard. One small query learns the sizes that decide the plan."""
    block_bytes = totals.agg(F.coalesce(F.sum(F.octet_length("file") + 64), F.lit(0))).scalar()
    sizes = per_file.agg(F.coalesce(F.sum("contexts"), F.lit(0)).alias("contexts")).withColumn("blocks", block_bytes)
    contexts, block_bytes = sizes.first()
    pieces = stream_pieces(streams, totals, seqlen, broadcast=block_bytes <= common.BROADCAST_LIMIT)
    padding = pad_pieces(per_file, seqlen, rules.pad).drop("is_pad")
    pieces = pieces.unionByName(padding)
    keyed = pieces.select(key_expr(seed, "file", "ctx").alias("key"), "offset", "tokens")
    counts = per_file.select("file", "contexts")
    placed, order = place_rows(keyed, counts, contexts, chunk_size, seed, shuffle, n_cells)
    named = placed.withColumn("name", F.concat("key", F.lit(MEMBER_SUFFIX)))
    return Placement(named, (order, "offset"), -(-contexts // chunk_size))


def tokenize_shuffle(
    spark: SparkSession,
    inputs: list[str] | str,
    output: str,
    encoder: Vocab | Callable[[Column], Column],
    tokenizer: str = NEOX,
    backend: str | None = None,
    seqlen: int = 2049,
    chunk_size: int = 8192,
    seed: int = 1234,
    ext: str | None = None,
    on_bad_record: str = "fail",
    shuffle: str = "global",
    n_cells: int = 128,
    input_json: str | None = None,
    output_json: str | None = None,
    work: str | None = None,
    rows_per_block: int | None = None,
    name_of: Callable[[Column], Column] | None = None,
) -> JobResult:
    """JSON-lines corpora to shuffled shard tars, manifest and card.

    ``encoder`` is a vocabulary, or a column function from text to ids. ``rows_per_block`` spreads
    a compressed file's lines over tasks before encoding, at the price of one shuffle of the text; it
    is for corpora of few, large compressed files. ``work`` takes the stored intermediates; by default it is
    a fresh path in the shared folder, and with ``on_bad_record="drop"`` the table of rejected records,
    (file, block, ord, reason) in ``rejects``. It can be dropped once the job is done. Streams are named by
    their file relative to the folder that holds all inputs; ``name_of`` (path to name, one to one) names them otherwise.
    """
    check_positive(seqlen=seqlen, chunk_size=chunk_size, n_cells=n_cells)
    backend = backend or (encoder.backend if isinstance(encoder, Vocab) else "hf")
    rules = preset(tokenizer, backend)
    check_unused(qualified(spark, output))
    parent = resolve_inputs(spark, inputs, ext).parent
    work = qualified(spark, work or scratch_path(spark, "tokenize"))

    lines = read_lines(spark, inputs, ext)
    # Rejects leave the pass that encodes beside the streams.
    docs = documents_of(check_records(lines), "keep" if on_bad_record == "drop" else on_bad_record)
    name = name_of(F.col("file")) if name_of else relative_name("file", parent)
    if rows_per_block:
        # Splits of a plain file are blocks already, and only within one is ``ord`` in file order.
        whole = F.col("file").rlike(COMPRESSED)
        docs = arrange_blocks(docs, block=F.when(whole, int_div("ord", rows_per_block)).otherwise(F.col("block")))
    docs = docs.withColumn("file", name)
    streams = encode_stage(docs, encoder, rules, seqlen, f"{work}/streams")
    rejects = None
    if on_bad_record == "drop":
        streams, rejects = split_rejects(streams)
        rejects = store(rejects, f"{work}/rejects")
    files = scanned_files(lines).select(name.alias("file"))
    totals, per_file = account_stage(streams, rules, seqlen, work, files)

    placed = shard_pieces(streams, totals, per_file, rules, seqlen, chunk_size, seed, shuffle, n_cells)
    write_shards(placed.rows, output, placed.order, placed.shards, seqlen)
    result = finish_job(spark, output, per_file, chunk_size, seqlen, tokenizer, input_json, output_json)
    result.rejects = 0 if rejects is None else rejects.count()
    result.work = work
    return result
