"""Where each document starts and ends in its file's token stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ctxloom.functions.arith import int_div

# Order values per window partition: no task sorts more rows of one file than this.
ROWS_PER_RANGE = 65536


def named(df: DataFrame, file: str = "file") -> DataFrame:
    """``df``, failing on rows without a stream name: joins by name would lose them."""
    missing = F.raise_error(F.lit("a row has no stream name")).cast(df.schema[file].dataType)
    return df.withColumn(file, F.coalesce(F.col(file), missing))


def _before(value: str, keys: list[str], order: Column | str) -> Column:
    """Sum of ``value`` over the rows before the current one."""
    window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0)).cast("bigint")


def range_totals(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Totals per (file, ..., range): partial sums are combined before the shuffle."""
    return df.groupBy(*keys).agg(F.sum(value).cast("bigint").alias("total"))


def range_bases(totals: DataFrame, levels: list[str]) -> DataFrame:
    """Running base of every range, summed level by level from the file down.

    ``levels`` is the key path, file first. Each window covers one parent's children only.
    """
    bases = None
    for depth in range(1, len(levels)):
        parent, here = levels[:depth], levels[: depth + 1]
        rows = totals if here == levels else totals.groupBy(*here).agg(F.sum("total").alias("total"))
        part = rows.select(*here, _before("total", parent, levels[depth]).alias("_part"))
        base = F.col("_part")
        if bases is not None:
            part, base = part.join(bases, parent), F.col("base") + F.col("_part")
        bases = part.select(*here, base.alias("base"))
    return bases


def stream_offsets(
    df: DataFrame, n: str = "n", file: str = "file", block: str | None = None, ord: str = "ord",
    rows_per_range: int = ROWS_PER_RANGE, depth: int = 1,
) -> DataFrame:
    """Add ``b`` and ``e``: the document's token span [b, e) in its file.

    A running sum per file would put a file of any size in one task. Here the order column is cut
    into ranges; rows are summed inside a range, and the small table of range totals is summed
    across ranges and joined back. The join reuses the window's partitioning. ``depth`` adds levels
    of ranges of ranges, for order columns so sparse that ranges hold few rows. A null name is an error.
    """
    df = named(df, file)
    ranges = [f"_r{i}" for i in range(depth, 0, -1)]
    levels = [file] + ([block] if block else []) + ranges
    for i in range(1, depth + 1):
        df = df.withColumn(f"_r{i}", int_div(ord, rows_per_range**i))
    inner = df.withColumn("_in", _before(n, levels, ord))
    bases = range_bases(range_totals(df, levels, n), levels)
    start = F.col("base") + F.col("_in")
    return (
        inner.join(bases, levels)
        .withColumn("b", start)
        .withColumn("e", start + F.col(n))
        .drop("_in", "base", *ranges)
    )


def file_totals(df: DataFrame, n: str = "n", file: str = "file") -> DataFrame:
    """(file, total) tokens of each file."""
    return df.groupBy(file).agg(F.sum(n).cast("bigint").alias("total"))
