"""Cell-wise shuffle: full chunks per cell, leftovers re-scattered to fewer cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ctxloom.functions.arith import int_div
from ctxloom.functions.keys import cell_expr, key_expr, shuffle_key
from ctxloom.operators.packing import check_positive
from ctxloom.operators.shuffle import bucket_bases, bucketed_rank
from ctxloom.runtime import cut_lineage

# Fixed value of the scheme: each round has a sixteenth of the cells.
REDUCTION = 16
# Tables of a row per cell are broadcast up to this many cells, 32 bytes each.
_BROADCAST_CELLS = 1 << 20


def cell_levels(n_cells: int) -> list[int]:
    """Cells per round. After the first step the count never falls below one before it ends."""
    check_positive(n_cells=n_cells)
    levels = [n_cells]
    following = n_cells // REDUCTION
    while following:
        levels.append(following)
        following = 0 if following == 1 else max(following // REDUCTION, 1)
    return levels


def cascade_shards(
    df: DataFrame, n_cells: int, chunk_size: int, seed: int, ids: tuple[str, ...] = ("file", "ctx")
) -> DataFrame:
    """(ids, key, round, cell, blk, idx, shard) for every row.

    Pass narrow rows and join payloads later. Cells are few, so ranks inside a cell are taken over
    key buckets. Each round's leftovers are fewer than cells x chunk; they are checkpointed, so a
    round does not recompute those before it.
    """
    check_positive(chunk_size=chunk_size)
    levels = cell_levels(n_cells)
    todo = shuffle_key(df.select(*ids), seed, ids)
    done = None
    for round_no, cells in enumerate(levels):
        ranked = cut_lineage(_rank_round(todo, round_no, cells, round_no == len(levels) - 1, chunk_size, seed, ids))
        final = ranked.filter("_final").drop("_final")
        done = final if done is None else done.unionByName(final)
        todo = ranked.filter("not _final").select(*ids, "key")
    return _number_shards(done, sum(levels))


def _by_cell(table: DataFrame, cells: int) -> DataFrame:
    """A table of at most ``cells`` rows, broadcast if that is few: cells are few and hot, so rows must not meet by cell."""
    return F.broadcast(table) if cells <= _BROADCAST_CELLS else table


def _rank_round(
    todo: DataFrame, round_no: int, cells: int, last: bool, chunk_size: int, seed: int, ids: tuple[str, ...]
) -> DataFrame:
    """One round's places of the rows (ids, key); ``_final`` says which stay there.

    Rows are shuffled once, by (cell, bucket); the sizes of cells and buckets are counted before that.
    """
    # Every round draws anew: its cell digits come from a key of its own.
    draw = F.col("key") if round_no == 0 else key_expr(seed, F.lit(f"round{round_no}"), "key")
    placed = todo.withColumn("_draw", draw).withColumn("cell", cell_expr(cells, "_draw", start=9)).drop("_draw")
    bases = bucket_bases(placed, ("cell",))
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("_size"))
    ranked = bucketed_rank(placed, "_rank", within=("cell",), ties=ids, bases=bases)
    ranked = ranked.join(_by_cell(sizes, cells), "cell")
    full = F.col("_rank") < F.col("_size") - F.pmod("_size", F.lit(chunk_size))
    return ranked.select(
        *ids,
        "key",
        F.lit(round_no).alias("round"),
        "cell",
        int_div("_rank", chunk_size).alias("blk"),
        F.pmod("_rank", F.lit(chunk_size)).cast("int").alias("idx"),
        (F.lit(True) if last else full).alias("_final"),
    )


def _number_shards(done: DataFrame, cells: int) -> DataFrame:
    """Dense shard numbers in (round, cell, blk) order, so short shards come last.

    Numbers follow from shards per (round, cell), a table no larger than ``cells``, the cells of all rounds.
    """
    per_cell = done.groupBy("round", "cell").agg((F.max("blk") + 1).alias("_shards"))
    before = Window.orderBy("round", "cell").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_cell.select("round", "cell", F.coalesce(F.sum("_shards").over(before), F.lit(0)).alias("_base"))
    return (
        done.join(_by_cell(bases, cells), ["round", "cell"])
        .withColumn("shard", (F.col("_base") + F.col("blk")).cast("bigint"))
        .drop("_base")
    )
