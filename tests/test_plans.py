"""What the physical plans must and must not do."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ctxloom.functions.encoders import encode_word_hash, word_count
from ctxloom.operators.cascade import _number_shards, _rank_round
from ctxloom.operators.offsets import stream_offsets
from ctxloom.operators.shuffle import enumerate_contexts, global_shuffle, shard_lookup, shuffle_key
from ctxloom.operators.streams import arrange_blocks, block_streams
from ctxloom.plans.tokenize_shuffle import account_stage, encode_stage, shard_pieces
from ctxloom.runtime import scratch_path, spread_small
from ctxloom.sources.documents import read_documents


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def exchanges(df):
    """Input columns of every shuffle or broadcast in the plan."""
    found = re.findall(r"\(\d+\) (?:Broadcast)?Exchange\nInput \[\d+\]: \[(.*?)\]\n", plan_of(df))
    return [set(re.findall(r"(\w+)#", columns)) for columns in found]


@pytest.fixture(scope="module")
def staged(spark, sf):
    work = scratch_path(spark, "plans")
    docs = arrange_blocks(entry._documents(spark, sf))
    streams = encode_stage(docs, encode_word_hash, entry.RULES, 64, f"{work}/streams")
    return streams, *account_stage(streams, entry.RULES, 64, work)


def test_tokens_reach_their_shard_unshuffled(staged):
    ready = shard_pieces(*staged, entry.RULES, 64, 16, 1).rows
    columns = exchanges(ready)
    assert columns and not any("tokens" in c for c in columns)


def test_ranks_move_no_tokens(spark, sf, staged):
    _, _, per_file = staged
    counts = per_file.select("file", "contexts")
    for df in (global_shuffle(enumerate_contexts(counts), 1), shard_lookup(counts, 1, 8)):
        assert not any("tokens" in c or "text" in c for c in exchanges(df))


def test_block_totals_read_no_tokens(staged):
    from ctxloom.operators.streams import block_totals

    scans = re.findall(r"ReadSchema: struct<(.*)>", plan_of(block_totals(staged[0])))
    assert scans and not any("tokens" in s for s in scans)


def test_offsets_move_lengths_only(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(
        F.col("source").alias("file"), F.col("doc_id").alias("ord"), word_count(F.col("text")).alias("n")
    )
    offsets = stream_offsets(docs)
    assert not any("text" in c for c in exchanges(offsets))
    # No window may see a whole file's documents: each is partitioned by range as well.
    windows = re.findall(r"windowspecdefinition\(([^)]*?) ASC", plan_of(offsets))
    assert any("_r1#" in w for w in windows)


def test_scan_to_streams_is_one_stage(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"text":"a b"}\n')
    docs = read_documents(spark, str(tmp_path)).withColumn("tokens", encode_word_hash(F.col("text")))
    assert exchanges(block_streams(docs, entry.RULES, 8)) == []


def test_only_small_tables_are_spread(spark, sf, monkeypatch):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    assert len(exchanges(spread_small(table))) == 1
    monkeypatch.setattr("ctxloom.runtime._SPLIT_BYTES", 1)
    assert exchanges(spread_small(table)) == []


def test_cells_move_rows_once_and_never_by_cell(spark):
    rows = spark.range(10**10).select(F.lit("f").alias("file"), F.col("id").alias("ctx"))
    ranked = _rank_round(shuffle_key(rows, 1), 0, 128, False, 8192, 1, ("file", "ctx"))
    moved = [c for c in exchanges(ranked) if "ctx" in c]
    assert len(moved) == 1 and {"cell", "bucket"} <= moved[0]
    n = F.col("ctx")
    done = rows.select("file", "ctx", F.lit(0).alias("round"), F.pmod(n, F.lit(128)).alias("cell"), F.floor(n / 128).alias("blk"))
    assert not any("ctx" in c for c in exchanges(_number_shards(done, 137)))
