"""Removal of repeated lines, exact and within one edit, by a join of deletion neighbourhoods.

Two lines are one edit apart if they have a common variant: each without one character at the same place
(one was replaced), or one as it is and the other without a character (one was inserted). All variants of
all lines would be hundreds per line. So lines first meet on a few keys that leave out a quarter of the
line; only lines that share such a key with another line emit their variants.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ctxloom.llm.common import stored, wide_hash
from ctxloom.runtime import ship_package

MIN_CHARS = 20  # for the comparison within one edit
_NOT_BLANK = r"(?U)\S"
_QUARTERS = 4
_SLOTS = 1 << 20
_VARIANT_ROWS = 1 << 16


def _keyed(docs: DataFrame) -> DataFrame:
    """(d1, d2, pos, lines, _row): rows with the same doc_id and text have the same key."""
    d1, d2 = wide_hash("doc_id", "text")
    packed = docs.select("doc_id", "text", F.struct("*").alias("_row"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), d1.alias("hash"))
    return packed.select(d1.alias("d1"), d2.alias("d2"), order.alias("doc"), F.split("text", "\n", -1).alias("lines"), "_row")


def _class(n: Column) -> Column:
    """Lengths in steps of at most a quarter: three leading bits of n, the rest zero."""
    unit = F.floor(F.log2(n.cast("double") + 0.25)).cast("int") - 2
    unit = F.greatest(unit, F.lit(0))
    return F.call_function("shiftleft", F.expr("1"), unit) * F.floor(n / F.call_function("shiftleft", F.expr("1"), unit))


def _gap_keys(lines: DataFrame, by_length: bool) -> DataFrame:
    """(key, h1): hashes of the line without one quarter, counted in quarters of the length class.

    An edit lies in one of the quarters, so two lines one edit apart agree before and after it. A length
    that begins a class also gets the keys of the class before, where a line of one character less is.
    ``by_length`` puts the length of the longer line of a pair into the key.
    """
    n = F.char_length("line")
    if by_length:
        classes = F.array(n, n + 1)
        quarter = F.floor((F.col("c") - 1) / _QUARTERS)
    else:
        classes = F.array_distinct(F.array(_class(n), _class(n - 1)))
        quarter = F.floor(F.col("c") / _QUARTERS)
    spread = lines.select("h1", "line", F.explode(classes.cast("array<bigint>")).alias("c"))
    spread = spread.select("h1", "line", "c", F.explode(F.sequence(F.lit(0), F.lit(_QUARTERS - 1))).alias("gap"))
    before = (quarter * F.col("gap")).cast("int")
    after = (quarter * (_QUARTERS - 1 - F.col("gap"))).cast("int")
    key = F.xxhash64("c", "gap", F.left("line", before), F.when(after > 0, F.right("line", after)).otherwise(F.lit("")))
    return spread.select(key.alias("key"), "h1")


def _sharing(lines: DataFrame, by_length: bool) -> DataFrame:
    """(h1) of the lines that share a key with a different one."""
    keys = _gap_keys(lines, by_length)
    met = keys.groupBy("key").agg(F.min("h1").alias("least"), F.max("h1").alias("most")).filter("least <> most")
    return keys.join(met.select("key"), "key").select("h1").distinct()


def _candidates(lines: DataFrame, firsts: DataFrame) -> DataFrame:
    """(h1, h2, line, n, first): the different lines that can have one within an edit.

    Their hashes are found without moving a text. A filter of fixed size then holds back most other
    lines where they are read, before texts are gathered and the rest is left out by a join.
    """
    hashes = stored(_sharing(lines, False), "sharing")
    slot = F.pmod("h1", F.lit(_SLOTS)).alias("slot")
    slots = F.broadcast(hashes.select(slot).distinct())  # never more than _SLOTS numbers
    some = lines.withColumn("slot", slot).join(slots, "slot", "left_semi")
    some = some.groupBy("h1", "h2").agg(F.any_value("line").alias("line")).join(hashes, "h1", "left_semi")
    some = stored(some.join(firsts, ["h1", "h2"]).withColumn("n", F.char_length("line")), "sharing")
    return stored(some.join(_sharing(some, True), "h1", "left_semi"), "sharing")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def variant_hashes(line: str, seed: int) -> np.ndarray:
    """Hashes of the line as it is and without its first, second, ... character, in time linear in its length.

    A text's hash is the sum of a number for each (character, place). What stands behind a character left
    out moves up by one place, so a variant is a running sum of the line's numbers and one of the moved ones.
    """
    chars = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) << np.uint64(32)
    salt = np.uint64(seed)
    own = _mix(_mix(chars + np.arange(1, len(chars) + 1, dtype=np.uint64)) ^ salt)
    moved = _mix(_mix(chars + np.arange(len(chars), dtype=np.uint64)) ^ salt)
    before = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own)])
    behind = np.concatenate([np.cumsum(moved[::-1])[::-1], np.zeros(1, np.uint64)])
    return np.concatenate([before[-1:], before[:-1] + behind[1:]]).view(np.int64)


def _variants(lines: DataFrame) -> DataFrame:
    """(me, i, v): the hash of each line (i = 0) and of each variant without its i-th character."""
    ship_package(lines.sparkSession)
    seed = secrets.randbits(64)  # nobody knows it beforehand, so no line can be written to collide

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            me = batch.column("me")
            held, rows = [], 0

            def out() -> pa.RecordBatch:
                which = np.concatenate([np.full(len(v), k) for k, _, v in held])
                places = np.concatenate([np.arange(at, at + len(v), dtype=np.int32) for _, at, v in held])
                return pa.RecordBatch.from_arrays(
                    [me.take(pa.array(which)), pa.array(places), pa.array(np.concatenate([v for _, _, v in held]))], ["me", "i", "v"]
                )

            for k in range(batch.num_rows):
                hashes = variant_hashes(batch.column("line")[k].as_py(), seed)
                for at in range(0, len(hashes), _VARIANT_ROWS):
                    held.append((k, at, hashes[at : at + _VARIANT_ROWS]))
                    rows += len(held[-1][2])
                    if rows >= _VARIANT_ROWS:
                        yield out()
                        held, rows = [], 0
            if held:
                yield out()

    sent = lines.select("line", F.struct("first", "h1", "h2").alias("me"))
    schema = StructType([sent.schema["me"], StructField("i", IntegerType()), StructField("v", LongType())])
    return sent.mapInArrow(run, schema)


def _near_earlier(lines: DataFrame) -> DataFrame:
    """(h1, h2) of the lines that have an earlier line within one edit; ``lines`` are different texts.

    Of the lines that lack the same character place only the earliest is a partner: they are all one edit
    apart. So a variant's group is looked at once, not pair by pair, and no group is larger than the
    alphabet times the length.
    """
    variants = _variants(lines)
    entry = "struct(me, i)"
    same_place = f"min({entry}) over (partition by v, i)"
    whole = f"min(case when i = 0 then {entry} end) over (partition by v)"
    shorter = f"min(case when i > 0 then {entry} end) over (partition by v)"
    ahead = variants.select("me", "i", F.expr(f"case when i = 0 then {shorter} else least({same_place}, {whole}) end").alias("ahead"))
    pairs = ahead.filter("ahead.me < me").groupBy(
        F.col("me.h1").alias("h1"), F.col("me.h2").alias("h2"), F.col("ahead.me.h1").alias("p1"), F.col("ahead.me.h2").alias("p2")
    ).agg(F.min(F.struct("i", F.col("ahead.i").alias("j"))).alias("at"))
    other = lines.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("line").alias("other"))
    verified = pairs.join(lines.select("h1", "h2", "line"), ["h1", "h2"]).join(other, ["p1", "p2"])
    # Equal texts after the edit are an edit distance of one, found in linear time.
    return verified.filter(_without("line", F.col("at.i")) == _without("other", F.col("at.j"))).select("h1", "h2").distinct()


def _without(text: str, place: Column) -> Column:
    """The text without the character at a place counted from 1; as it is for place 0."""
    return F.when(place == 0, F.col(text)).otherwise(F.concat(F.left(text, place - 1), F.substring(F.col(text), place + 1, F.char_length(text))))


def mark_lines(docs: DataFrame, min_chars: int | None = None) -> DataFrame:
    """(_row, n_lines, removed, kept): each row of ``docs`` with the numbers of the lines that go and the text that stays.

    Lines end at each newline character. A line goes if an equal one comes before it, in this document or
    an earlier one, whether or not that one stays; blank lines, of white space alone, always stay. A line of
    MIN_CHARS characters or more also goes if such a line comes before it that is one edit (a character put
    in, left out or replaced) away. With ``min_chars`` that number holds for both: shorter lines then always
    stay, also if they are repeated. Documents are ordered by doc_id, then by a hash of doc_id and text;
    those without doc_id come last. Rows with the same doc_id and text are one document and get the same
    result. Null texts have no lines and stay null; an empty text is one empty line. ``_row`` holds all
    columns as they were.
    """
    keyed = _keyed(docs)
    exploded = keyed.select("d1", "d2", "doc", F.posexplode("lines").alias("no", "line"))
    h1, h2 = wide_hash("line")
    compared = F.col("line").rlike(_NOT_BLANK) if min_chars is None else F.char_length("line") >= min_chars
    lines = exploded.filter(compared).withColumns({"h1": h1, "h2": h2})
    editable = lines.filter(F.char_length("line") >= (MIN_CHARS if min_chars is None else min_chars))
    placed = lines.select("h1", "h2", F.struct("doc", "no").alias("pos"), "d2")  # d1 is the document's hash in pos
    firsts = stored(placed.groupBy("h1", "h2").agg(F.min("pos").alias("first")), "lines")
    near = _near_earlier(_candidates(editable.select("h1", "h2", "line"), firsts))
    known = firsts.join(near.withColumn("near", F.lit(True)), ["h1", "h2"], "left")
    gone = placed.join(known, ["h1", "h2"]).filter("near or pos > first")
    gone = gone.select(F.col("pos.doc.hash").alias("d1"), "d2", F.col("pos.no").alias("no"))
    per_doc = gone.groupBy("d1", "d2").agg(F.collect_set("no").alias("gone"))
    joined = keyed.select("d1", "d2", "lines", "_row").join(per_doc, ["d1", "d2"], "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.array_join(F.transform(stay, lambda i: F.col("lines")[i]), "\n")
    return joined.select(
        "_row",
        F.greatest(F.size("lines"), F.lit(0)).cast("bigint").alias("n_lines"),
        F.array_sort(F.coalesce("gone", F.array().cast("array<int>"))).alias("removed"),
        F.when(F.col("gone").isNull(), F.col("_row.text")).otherwise(kept).alias("kept"),
    )


def without_repeated_lines(docs: DataFrame, min_chars: int | None = MIN_CHARS) -> DataFrame:
    """``docs`` with the kept text in place of the text; rows of which no line is left go. Other columns pass through.

    ``min_chars`` as in ``mark_lines``; here shorter lines stay unless None is given.
    """
    marked = mark_lines(docs, min_chars).filter("n_lines = 0 or size(removed) < n_lines")
    columns = [F.col("kept").alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns]
    return marked.select(*columns)
