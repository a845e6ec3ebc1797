"""Seeded global shuffle and shard assignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ctxloom.functions.arith import int_div
from ctxloom.functions.keys import BUCKET_DIGITS, bucket_expr, key_expr, shuffle_key
from ctxloom.operators.packing import check_positive
from ctxloom.runtime import parallelism

# Contexts named by one row before the second explode.
_CTX_STRIDE = 65536


def bucket_bases(df: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """(within, bucket, base): rows in the buckets before, from rows with a ``key``.

    The window sees bucket sizes, at most 65,536 rows per group.
    """
    sizes = df.groupBy(*within, bucket_expr().alias("bucket")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*within).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(*within, "bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("base"))


def bucketed_rank(
    df: DataFrame, out: str, within: tuple[str, ...] = (), ties: tuple[str, ...] = (), bases: DataFrame | None = None
) -> DataFrame:
    """Dense rank from 0 in ``key`` order, over everything or per ``within`` group.

    Rows are ranked inside key-prefix buckets; bucket sizes give each bucket's base. The buckets are
    uniform because the key is a hash, so neither the whole data nor a hot group meets in one task.
    """
    bases = bucket_bases(df, within) if bases is None else bases
    inside = Window.partitionBy(*within, "bucket").orderBy("key", *ties)
    return (
        df.withColumn("bucket", bucket_expr())
        .withColumn("_row", F.row_number().over(inside))
        .join(bases, [*within, "bucket"])
        .withColumn(out, (F.col("base") + F.col("_row") - 1).cast("bigint"))
        .drop("bucket", "_row", "base")
    )


def global_shuffle(df: DataFrame, seed: int, ids: tuple[str, ...] = ("file", "ctx")) -> DataFrame:
    """Add ``key`` and ``rank``: a random permutation of all rows, the same for the same seed."""
    return bucketed_rank(shuffle_key(df, seed, ids), "rank", ties=ids)


def assign_shards(df: DataFrame, chunk_size: int) -> DataFrame:
    """Add ``shard`` and ``idx`` from ``rank``; only the last shard can be short."""
    check_positive(chunk_size=chunk_size)
    rank = F.col("rank")
    return df.withColumn("shard", int_div(rank, chunk_size)).withColumn(
        "idx", F.pmod(rank, F.lit(chunk_size)).cast("int")
    )


def enumerate_contexts(counts: DataFrame) -> DataFrame:
    """(file, ctx) for ctx in [0, contexts), from (file, contexts) alone.

    Two explodes with a shuffle of the strides between them, so one huge file is spread over tasks
    and no array holds more than one stride.
    """
    zero, stride = F.lit(0).cast("bigint"), F.lit(_CTX_STRIDE).cast("bigint")
    strides = counts.filter("contexts > 0").select(
        "file", "contexts", F.explode(F.sequence(zero, F.col("contexts") - 1, stride)).alias("_lo")
    )
    strides = strides.repartition(parallelism(counts.sparkSession))
    last = F.least(F.col("_lo") + _CTX_STRIDE, F.col("contexts")) - 1
    return strides.select("file", F.explode(F.sequence("_lo", last)).alias("ctx"))


def shard_lookup(counts: DataFrame, seed: int, chunk_size: int) -> DataFrame:
    """Where each shard begins in key space: (bucket, first, bounds), at most 65,536 rows.

    Key order is fixed by (seed, file, ctx), so shard borders follow from the number of contexts per
    file. Ranking touches these narrow keys only; tokens are later sent straight to their shard.
    """
    check_positive(chunk_size=chunk_size)
    keys = enumerate_contexts(counts).select(key_expr(seed, "file", "ctx").alias("key"))
    bases = bucket_bases(keys)
    first = int_div(F.col("base") + chunk_size - 1, chunk_size)
    borders = (
        bucketed_rank(keys, "rank", bases=bases)
        .filter(F.pmod("rank", F.lit(chunk_size)) == 0)
        .groupBy(bucket_expr().alias("bucket"))
        .agg(F.array_sort(F.collect_list("key")).alias("bounds"))
    )
    none = F.array().cast("array<string>")
    return bases.join(borders, "bucket", "left").select(
        "bucket", first.alias("first"), F.coalesce("bounds", none).alias("bounds")
    )


def locate_shards(df: DataFrame, lookup: DataFrame, broadcast: bool) -> DataFrame:
    """Add ``shard`` to rows with a ``key``, without moving them when the lookup is broadcast."""
    table = F.broadcast(lookup) if broadcast else lookup
    begun = F.size(F.filter("bounds", lambda b: b <= F.col("key")))
    return (
        df.withColumn("bucket", bucket_expr())
        .join(table, "bucket")
        .withColumn("shard", (F.col("first") + begun - 1).cast("bigint"))
        .drop("bucket", "first", "bounds")
    )


def lookup_bytes(contexts: int, chunk_size: int) -> int:
    """Upper bound on the size of ``shard_lookup``: its rows, and a 32-digit key per shard."""
    return 64 * min(contexts, 16**BUCKET_DIGITS) + 48 * (contexts // chunk_size + 1)
