"""JSON-lines documents: scan, record checks, text projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ctxloom.sources.listing import resolve_inputs, text_scans
from ctxloom.sources.paths import decoded_path

# Plain JSON only: no single quotes, no NaN. Texts may be longer than the parser's usual limit of 20 million characters.
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false", "maxStringLen": str(2**31 - 1)}


def read_lines(spark: SparkSession, paths: list[str] | str, ext: str | None = None) -> DataFrame:
    """(file, block, ord, line): one row per line, in file order by (block, ord).

    ``block`` is the start of the file split, so an uncompressed file is read by many tasks; gzip and
    zstd files are one block. ``ord`` rises within a block and is taken in the scan itself.
    """
    out = None
    for scan in text_scans(spark, resolve_inputs(spark, paths, ext)):
        lines = scan.select(
            decoded_path(F.col("_metadata.file_path")).alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("ord"),
            F.col("value").alias("line"),
        )
        out = lines if out is None else out.unionByName(lines)
    return out


def _parsed(line: Column) -> tuple[Column, Column]:
    """(array holding the record or null, whether the line is exactly one JSON value).

    The reader stops after the first value, so the line is wrapped in brackets to bring trailing text
    into view. A line that closes the bracket itself is parsed once more in another wrapping. Only
    ``text`` is built; every other key is skipped by the parser.
    """
    as_item = F.from_json(F.concat(F.lit("["), line, F.lit("]")), "array<struct<text: variant>>", _STRICT)
    as_member = F.from_json(F.concat(F.lit('{"r":'), line, F.lit("}")), "struct<r: struct<text: variant>>", _STRICT)
    closes_bracket = line.contains("]") & line.rlike(r"\}\s*\]")
    single = F.when(closes_bracket, as_member["r"].isNotNull()).otherwise(F.lit(True))
    return as_item, single


# Escaped backslashes and whole pairs are passed over; a half of a pair that remains stands alone.
_PAIRS = r"\\\\|\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}"
_HALF = r"\\u[dD][89a-fA-F][0-9a-fA-F]{2}"


def _lone_surrogate(line: Column) -> Column:
    return line.rlike(_HALF) & F.regexp_replace(line, _PAIRS, "").rlike(_HALF)


def check_records(lines: DataFrame) -> DataFrame:
    """Add ``text`` and ``reason``; exactly one of them is null.

    A record must be a JSON object whose ``text`` is a string. The last of repeated keys counts. Escapes
    that name half a character are no text, wherever they stand in the line.

    Both columns come out of a generator of one row, so that a filter on them stays above it: pushed
    below, its condition would parse each line again for every time it names the record.
    """
    item, single = _parsed(F.col("line"))
    utf8 = F.is_valid_utf8(F.col("line"))
    staged = lines.withColumn("_utf8", utf8).withColumn("_item", F.when(utf8, item)).withColumn("_single", single)
    kind = F.schema_of_variant(F.col("_value"))
    staged = staged.withColumn("_value", F.when(F.size("_item") == 1, F.col("_item")[0]["text"]))
    reason = (
        F.when(~F.col("_utf8"), "invalid utf-8")
        .when(~F.col("line").rlike(r"\S"), "blank")
        .when(
            F.col("_item").isNull() | (F.size("_item") != 1) | ~F.col("_single") | F.col("_item")[0].isNull(),
            "not a JSON object",
        )
        .when(_lone_surrogate(F.col("line")), "half a character")
        .when(F.col("_value").isNull(), "missing text")
        .when(kind == "VOID", "null text")
        .when(kind != "STRING", "text is not a string")
    )
    staged = staged.withColumn("_reason", reason)
    text = F.when(F.col("_reason").isNull(), F.try_variant_get("_value", "$", "string"))
    both = F.array(F.struct(text.alias("text"), F.col("_reason").alias("reason")))
    return staged.select(*lines.columns, F.inline_outer(both))


def split_bad_records(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good documents, rejects with a reason)."""
    checked = check_records(lines)
    good = checked.filter(F.col("reason").isNull()).select("file", "block", "ord", "text")
    rejects = checked.filter(F.col("reason").isNotNull()).select("file", "block", "ord", "reason")
    return good, rejects


def documents_of(checked: DataFrame, on_bad_record: str = "fail") -> DataFrame:
    """(file, block, ord, text) of checked lines; with ``'keep'`` also bad ones, and their reason."""
    if on_bad_record not in ("fail", "drop", "keep"):
        raise ValueError("on_bad_record is 'fail', 'drop' or 'keep'")
    if on_bad_record == "keep":
        return checked.select("file", "block", "ord", "text", "reason")
    if on_bad_record == "drop":
        return checked.filter(F.col("reason").isNull()).select("file", "block", "ord", "text")
    complaint = F.concat(F.lit("bad record in "), "file", F.lit(": "), "reason")
    # As a filter the check stays in the plan, whichever columns are read.
    good = F.when(F.col("reason").isNull(), F.lit(True)).otherwise(F.raise_error(complaint).cast("boolean"))
    return checked.filter(good).select("file", "block", "ord", "text")


def read_documents(
    spark: SparkSession, paths: list[str] | str, ext: str | None = None, on_bad_record: str = "fail"
) -> DataFrame:
    """(file, block, ord, text). Bad records stop the job, or are left out with ``'drop'``."""
    return documents_of(check_records(read_lines(spark, paths, ext)), on_bad_record)
