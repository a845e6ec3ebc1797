"""Cut each file's token stream into contexts of equal length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctxloom.functions.arith import int_div
from ctxloom.operators.offsets import file_totals, stream_offsets


def check_positive(**values: int) -> None:
    for name, value in values.items():
        if value < 1:
            raise ValueError(f"{name} must be at least 1")


def _spans(seqlen: int, with_tokens: bool) -> Column:
    """Array of the parts of the document [b, e), one per context it touches.

    The parts are built inside the array, so a long document's tokens are not copied to each row.
    """
    b, e = F.col("b"), F.col("e")

    def part(ctx: Column) -> Column:
        lo = F.greatest(ctx * seqlen, b)
        hi = F.least((ctx + 1) * seqlen, e)
        fields = [
            ctx.alias("ctx"),
            (lo - ctx * seqlen).cast("int").alias("offset"),
            (lo - b).alias("doc_offset"),
            (hi - lo).cast("int").alias("len"),
        ]
        if with_tokens:
            fields.append(F.slice("tokens", (lo - b + 1).cast("int"), (hi - lo).cast("int")).alias("part"))
        return F.struct(*fields)

    ctxs = F.sequence(int_div(b, seqlen), int_div(e - 1, seqlen))
    return F.transform(ctxs, part)


def context_spans(offsets: DataFrame, seqlen: int, ids: tuple[str, ...] = ("file", "ord")) -> DataFrame:
    """(file, ctx, doc ids, offset in context, offset in document, len): which documents feed a context."""
    check_positive(seqlen=seqlen)
    spans = offsets.select(*ids, F.explode(_spans(seqlen, False)).alias("s"))
    return spans.select(*ids, "s.ctx", "s.offset", "s.doc_offset", "s.len")


def pad_pieces(totals: DataFrame, seqlen: int, pad: int, files: DataFrame | None = None) -> DataFrame:
    """The padding of every file as one piece (file, ctx, offset, tokens).

    Every file ends in a padded context; when its tokens fill whole contexts, or it has none, that
    context is padding alone. ``files`` adds the files without rows.
    """
    if files is not None:
        totals = files.select("file").distinct().join(totals, "file", "left")
    total = F.coalesce(F.col("total"), F.lit(0)).cast("bigint")
    used = F.pmod(total, F.lit(seqlen)).cast("int")
    return totals.select(
        "file",
        int_div(total, seqlen).alias("ctx"),
        used.alias("offset"),
        F.array_repeat(F.lit(pad).cast("int"), F.lit(seqlen) - used).alias("tokens"),
        F.lit(True).alias("is_pad"),
    )


def join_pieces(pieces: DataFrame) -> DataFrame:
    """(file, ctx, n_real, tokens) from pieces; a group holds at most ``seqlen`` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "tokens", "is_pad")))
    grouped = pieces.groupBy("file", "ctx").agg(parts.alias("_parts"))
    real = F.aggregate(
        "_parts", F.lit(0), lambda acc, p: acc + F.when(p["is_pad"], F.lit(0)).otherwise(F.size(p["tokens"]))
    )
    return grouped.select(
        "file", "ctx", real.alias("n_real"), F.flatten(F.transform("_parts", lambda p: p["tokens"])).alias("tokens")
    )


def pack_contexts(
    df: DataFrame, seqlen: int, pad: int, block: str | None = None, n: str | None = None,
    files: DataFrame | None = None,
) -> DataFrame:
    """Contexts (file, ctx, n_real, tokens) of framed documents (file, [block], ord, tokens).

    Streams are cut across document borders and never across files. Give ``n`` when the token count
    is at hand as a column; totals then never touch the token arrays.
    """
    check_positive(seqlen=seqlen)
    if n is None:
        df, n = df.withColumn("n", F.size("tokens").cast("bigint")), "n"
    offsets = stream_offsets(df, n=n, block=block)
    pieces = offsets.select("file", F.explode(_spans(seqlen, True)).alias("s")).select(
        "file", "s.ctx", "s.offset", F.col("s.part").alias("tokens"), F.lit(False).alias("is_pad")
    )
    return join_pieces(pieces.unionByName(pad_pieces(file_totals(df, n), seqlen, pad, files)))
