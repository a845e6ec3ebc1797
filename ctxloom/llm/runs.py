"""Periodic runs of words, by maximal pairs of an LCP-interval tree.

A run of period q that starts at word i is a maximal pair: the suffixes at i and i + q agree for the run's
length less q, no further, and the words on their left differ. So runs are enumerated from the tree of LCP
intervals over the sorted suffixes of a text, from the leaves up: where children of an interval of depth d
meet, positions of different children agree for exactly d words, and those with different left words are
maximal pairs. The bounds on length and exponent leave pairs with a distance of at most d / (exponent - 1).

Positions of an interval are kept in order. All occurrences of d words within half of d of each other lie in
one periodic stretch, so of those within reach before a position only the first can have another left word,
and the class of all others is passed over at once; behind it at most one has exactly the depth. An interval
costs a search per position of its smaller children, whatever the number of pairs.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctxloom.llm.common import release_memory, with_doc_id
from ctxloom.runtime import ship_package

MIN_LENGTH = 24
MIN_EXPONENT = 3
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)
_ROWS = 64


class Numbers(dict):
    """Numbers words by their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def word_numbers(words: list[bytes]) -> np.ndarray:
    numbers = Numbers()
    return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


def may_repeat(ids: np.ndarray, width: int) -> bool:
    """Whether a window of so many words may occur twice: certainly not if all windows' hashes differ."""
    if len(ids) <= width:
        return False
    h, have, k = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(_MULTIPLIERS[-1]), 1, 0
    while have < width:
        step = min(have, width - have)
        h = (h[:-step] ^ (h[:-step] >> np.uint64(29))) * np.uint64(_MULTIPLIERS[k % 4]) + h[step:]
        have, k = have + step, k + 1
    h.sort()
    return bool((h[1:] == h[:-1]).any())


# ---------------------------------------------------------------- sorted suffixes


def sorted_suffixes(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in order, and how many words each has in common with the one before (0 for the first)."""
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int32)
    levels, width = [], 1
    while True:
        levels.append(np.append(rank, np.int32(-1)))
        behind = np.zeros(n, np.int64)
        behind[: n - width] = rank[width:] + np.int64(1)
        key = rank.astype(np.int64) * (n + 1) + behind
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int32)
        new[order] = np.cumsum(np.concatenate([[0], np.diff(key[order]) != 0]), dtype=np.int32)
        rank, width = new, 2 * width
        if rank[order[-1]] == n - 1:
            break
    common = np.zeros(n, np.int64)
    one, other = order[:-1].copy(), order[1:].copy()
    for k in range(len(levels) - 1, -1, -1):
        same = (levels[k][one] == levels[k][other]).astype(np.int64) << k
        common[1:] += same
        one += same
        other += same
    return order, common


# ---------------------------------------------------------------- intervals


def _together(a: list[int], b: list[int]) -> list[int]:
    """Two ascending lists as one; the smaller goes into the larger."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    if large[-1] < small[0]:
        large += small
    elif len(small) < 8:
        for x in small:
            large.insert(bisect_left(large, x), x)
    else:
        large += small
        large.sort()
    return large


def runs_of(ids: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period.

    A run is a stretch with smallest period q, of ``min_length`` and of ``min_exponent`` (3 or more) times q
    words at least, that no neighbouring word extends keeping that period.
    """
    if min_exponent < 3:
        raise ValueError("runs of an exponent under three have pairs that are not within half their depth")
    # A run of length L has a pair of depth L - q, that is L (1 - 1 / exponent) or more.
    least = max(1, -(-min_length * (min_exponent - 1) // min_exponent))
    if len(ids) < min_length or not may_repeat(ids, least):
        return []
    order, common = sorted_suffixes(ids)
    left = [-1, *ids[:-1].tolist()]
    best: dict[tuple[int, int], int] = {}

    def pair(i: int, j: int, depth: int) -> None:
        q = j - i
        if depth + q >= min_length and best.get((i, depth + q), q) >= q:
            best[i, depth + q] = q

    def meet(a: list[int], b: list[int], depth: int) -> list[int]:
        small, large = (a, b) if len(a) < len(b) else (b, a)
        reach = depth // (min_exponent - 1)
        for x in small:
            low = bisect_left(large, x - reach)
            own = bisect_left(large, x, low)
            if low < own and left[large[low]] != left[x]:
                pair(large[low], x, depth)
            if own < len(large) and large[own] <= x + reach and left[large[own]] != left[x]:
                pair(x, large[own], depth)
        return _together(a, b)

    deep = np.nonzero(common >= least)[0]
    for block in np.split(deep, np.nonzero(np.diff(deep) != 1)[0] + 1):
        places = order[block[0] - 1 : block[-1] + 1].tolist()
        open_: list[tuple[int, list[int]]] = []
        now = [places[0]]
        for place, depth in zip([*places[1:], -1], [*common[block].tolist(), 0], strict=True):
            while open_ and open_[-1][0] > depth:
                d, before = open_.pop()
                now = meet(before, now, d)
            if open_ and open_[-1][0] == depth:
                d, before = open_.pop()
                now = meet(before, now, d)
            open_.append((depth, now))
            now = [place]
    return sorted((i, length, q) for (i, length), q in best.items())


def outside_repeats(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay if of each run only the first period does, unless another run has those words behind its own."""
    depth = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        depth[start + q] += 1
        depth[start + length] -= 1
    return np.cumsum(depth[:n]) == 0


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """(doc_id, n_words, runs, top, collapsed) of each text: its runs, the strongest of them, and the text without their repeats.

    Words are what stands between ASCII white space. ``runs`` are (start, length, period) in words, by start,
    then period; ``top`` is the one with the greatest length over period, the first, then that of the
    smallest period, among equals, and null without runs; ``collapsed`` has the words that stay, joined by a space. One row per
    row of ``docs``; null and empty texts have no words; doc_id is only carried along, other columns are
    not looked at. A text is worked on as a whole, in memory of about its words times their logarithm.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                counts, found, tops, kept = [], [], [], []
                for text in part.column("text").cast(pa.binary()).to_pylist():
                    words = (text or b"").split()
                    runs = runs_of(word_numbers(words), min_length, min_exponent)
                    counts.append(len(words))
                    found.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs])
                    best = max(range(len(runs)), key=lambda k: (Fraction(runs[k][1], runs[k][2]), -k), default=None)
                    tops.append(None if best is None else found[-1][best])
                    if runs:
                        stay = outside_repeats(len(words), runs)
                        words = [w for w, s in zip(words, stay.tolist(), strict=True) if s]
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(found, pa.list_(kind)), pa.array(tops, kind),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "top", "collapsed"],
                )
        release_memory()

    one = "struct<start: bigint, length: bigint, period: bigint>"
    schema = with_doc_id(docs, f"n_words bigint, runs array<{one}>, top {one}, collapsed string")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """``docs`` with the texts whose id's checksum is divisible by ten made periodic from some word on, joined by spaces.

    From word a on, of n, word i becomes word a + (i - a) mod p; a and p come from the rest of the checksum.
    Texts without words and rows without doc_id stay as they are.
    """
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    periodic = F.transform(
        F.sequence(F.lit(0), F.col("_n") - 1),
        lambda i: F.when(i < F.col("_a"), F.get("_words", i)).otherwise(F.get("_words", (F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int"))),
    )
    chosen = F.when(h % 10 == 0, words)
    rows = docs.withColumn("_words", chosen).withColumn("_n", F.size("_words")).withColumn("_a", F.when(F.col("_n") > 0, (g % F.col("_n")).cast("int")))
    rows = rows.withColumn("_p", (1 + F.floor((F.col("_n") - F.col("_a")) / (3 + g % 8))).cast("int"))
    text = F.when(F.col("_n") > 0, F.array_join(periodic, " ")).otherwise(F.col("text"))
    return rows.withColumn("text", text).drop("_words", "_n", "_a", "_p")


def runs_text(runs: str) -> Column:
    """``start,length,period`` of each run, each on a line of its own."""
    line = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return F.when(F.size(runs) > 0, F.concat(F.array_join(line, "\n"), F.lit("\n"))).otherwise(F.lit(""))
