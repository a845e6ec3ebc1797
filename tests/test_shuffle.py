import hashlib

import pytest
from pyspark.sql import functions as F

from ctxloom.functions.keys import assign_cells
from ctxloom.operators.cascade import cascade_shards, cell_levels
from ctxloom.operators.shuffle import (
    assign_shards, enumerate_contexts, global_shuffle, locate_shards, shard_lookup, shuffle_key,
)
from ctxloom.sources.manifest import manifest_rows, manifest_tokens


def contexts(spark, n, file="f"):
    return spark.range(n).select(F.lit(file).alias("file"), F.col("id").alias("ctx"))


def md5_order(n, seed, file="f"):
    return sorted(range(n), key=lambda c: hashlib.md5(f"{seed}|{file}|{c}".encode()).hexdigest())


def test_rank_is_key_order(spark):
    got = {r.ctx: r.rank for r in global_shuffle(contexts(spark, 500), 7).collect()}
    assert got == {c: i for i, c in enumerate(md5_order(500, 7))}


def test_same_seed_same_order_under_any_partitioning(spark):
    base = contexts(spark, 300)
    runs = [global_shuffle(base.repartition(k), 1) for k in (1, 7)]
    a, b = ({r.ctx: r.rank for r in run.collect()} for run in runs)
    assert a == b
    other = {r.ctx: r.rank for r in global_shuffle(base, 2).collect()}
    assert other != a and sorted(other.values()) == sorted(a.values())


@pytest.mark.parametrize("n,chunk,sizes", [(10, 4, [4, 4, 2]), (8, 4, [4, 4])])
def test_shards_of_global_rank(spark, n, chunk, sizes):
    assigned = assign_shards(global_shuffle(contexts(spark, n), 3), chunk)
    rows = manifest_rows(assigned).orderBy("shard").collect()
    assert [r.num_sequences for r in rows] == sizes
    assert [r.shard for r in rows] == [f"shard_{i:08d}" for i in range(len(sizes))]
    assert manifest_tokens(manifest_rows(assigned), 8).first()[0] == n * 8


def test_enumerate_contexts_splits_large_files(spark, monkeypatch):
    monkeypatch.setattr("ctxloom.operators.shuffle._CTX_STRIDE", 7)
    counts = spark.createDataFrame([("a", 20), ("b", 1), ("c", 7), ("d", 0)], "file string, contexts long")
    got = sorted((r.file, r.ctx) for r in enumerate_contexts(counts).collect())
    assert got == [("a", i) for i in range(20)] + [("b", 0)] + [("c", i) for i in range(7)]


@pytest.mark.parametrize("chunk", [1, 3, 64, 5000])
def test_lookup_equals_rank(spark, chunk):
    counts = spark.createDataFrame([("a", 700), ("b", 1), ("c", 299)], "file string, contexts long")
    all_rows = enumerate_contexts(counts)
    want = {(r.file, r.ctx): r.shard for r in assign_shards(global_shuffle(all_rows, 11), chunk).collect()}
    lookup = shard_lookup(counts, 11, chunk)
    for broadcast in (True, False):
        got = locate_shards(shuffle_key(all_rows, 11), lookup, broadcast)
        assert {(r.file, r.ctx): r.shard for r in got.collect()} == want


def test_cell_levels():
    assert cell_levels(128) == [128, 8, 1]
    assert cell_levels(512) == [512, 32, 2, 1]
    assert cell_levels(16) == [16, 1]
    assert cell_levels(8) == [8]
    assert cell_levels(300) == [300, 18, 1]
    with pytest.raises(ValueError):
        cell_levels(0)


def test_cells_are_in_range(spark):
    cells = assign_cells(contexts(spark, 400), 5, 1).groupBy("cell").count().collect()
    assert {r.cell for r in cells} == set(range(5))


@pytest.mark.parametrize("n_cells,chunk", [(128, 8), (16, 10), (8, 10), (1, 7)])
def test_cascade(spark, n_cells, chunk):
    n = 333
    got = cascade_shards(contexts(spark, n), n_cells, chunk, 5).collect()
    assert sorted(r.ctx for r in got) == list(range(n))
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r.idx)
    assert sorted(shards) == list(range(len(shards)))
    assert all(sorted(i) == list(range(len(i))) for i in shards.values())
    short = [s for s, i in shards.items() if len(i) < chunk]
    if n_cells >= 16 or n_cells == 1:
        assert len(shards) == -(-n // chunk)
        assert short in ([], [len(shards) - 1])
    else:
        assert len(short) <= n_cells
