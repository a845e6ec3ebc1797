"""Benchmark decontamination: Wu-Manber search for windows of benchmark words in documents."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctxloom.llm.common import texts, with_doc_id, worker_state
from ctxloom.runtime import ship_package

WINDOW = 10
BLOCK_BYTES = 16 << 20
# Fixed value: ASCII letters and digits and all bytes of other characters belong to words; the rest parts them.
_TABLE = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def split_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_TABLE).split()


class WuManber:
    """Search for word sequences of one length.

    A block is the last two words of a window (one word for windows of one). ``shift`` tells how far the
    window may move on when it ends in a block: as far as the block's last place in any pattern, or past
    it. Only where that is zero are the patterns of the block's bucket compared word for word.
    """

    def __init__(self, patterns: dict[tuple[bytes, ...], frozenset], length: int) -> None:
        self.length, self.block = length, min(2, length)
        self.shift: dict = {}
        self.buckets: dict = {}
        for words, items in patterns.items():
            for end in range(self.block, length + 1):
                block = self._at(words, end)
                self.shift[block] = min(self.shift.get(block, length), length - end)
            self.buckets.setdefault(self._at(words, length), {}).setdefault(words[0], []).append((words, items))

    def _at(self, words, end: int):
        return words[end - 1] if self.block == 1 else (words[end - 2], words[end - 1])

    def find(self, words: list[bytes]) -> Iterator[tuple[int, frozenset]]:
        """(start, items) of each occurrence, in order."""
        length, n, far = self.length, len(words), self.length - self.block + 1
        shift, buckets, at, end = self.shift.get, self.buckets, self._at, self.length
        while end <= n:
            block = (words[end - 2], words[end - 1]) if self.block == 2 else words[end - 1]
            step = shift(block, far)
            if step:
                end += step
                continue
            start = end - length
            for pattern, items in buckets[at(words, end)].get(words[start], ()):
                if all(words[start + i] == pattern[i] for i in range(length)):
                    yield start, items
            end += 1


def _windows(rows, window: int) -> dict[int, dict[tuple[bytes, ...], frozenset]]:
    """Patterns by length, each with the items that hold it."""
    found: dict[int, dict] = {}
    for item, text in rows:
        words = split_words(text or "")
        width = min(window, len(words))
        for at in range(len(words) - width + 1 if width else 0):
            found.setdefault(width, {}).setdefault(tuple(words[at : at + width]), set()).add(item)
    return {n: {words: frozenset(items) for words, items in own.items()} for n, own in found.items()}


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> list:
    """Broadcast patterns, at most about ``block_bytes`` of benchmark text in each."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + total // block_bytes
    out = []
    for k in range(n):
        own = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).distinct().collect()
        out.append(spark.sparkContext.broadcast(_windows(own, window)))
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, hits, items): which words of each document lie in benchmark windows, and whose.

    ``hits`` are arrays [start, end) of word places, apart from each other and in order; ``items`` are
    sorted item ids as strings. A window is ``window`` consecutive words of an item, or all words of a
    shorter one. The benchmark goes to the tasks in blocks of bounded size, searched one after another,
    so it may be of any size; documents are read once and not shuffled.

    One row per row of ``docs``. Null and empty texts have no words; items without words are never found;
    items that share an id count as one item, those without id as the item ``null``. Other columns are
    not looked at.
    """
    ship_package(docs.sparkSession)
    blocks = _blocks(benchmark, window, block_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("patterns", dict)
        kept: list = []

        def searchers() -> Iterator[WuManber]:
            if len(blocks) == 1 and kept:
                yield from kept
                return
            for block in blocks:
                for length, patterns in block.value.items():
                    searcher = WuManber(patterns, length)
                    if len(blocks) == 1:
                        kept.append(searcher)
                    yield searcher

        for batch in batches:
            words = [split_words(t) for t in texts(batch)]
            spans: list[list] = [[] for _ in words]
            items: list[set] = [set() for _ in words]
            for searcher in searchers():
                for k, own in enumerate(words):
                    for start, names in searcher.find(own):
                        items[k] |= names
                        if spans[k] and spans[k][-1][0] <= start <= spans[k][-1][1]:
                            spans[k][-1][1] = max(spans[k][-1][1], start + searcher.length)
                        else:
                            spans[k].append([start, start + searcher.length])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.array([_merged(s) for s in spans], pa.list_(pa.list_(pa.int64()))),
                    pa.array([sorted(s) for s in items], pa.list_(pa.string())),
                ],
                ["doc_id", "n_words", "hits", "items"],
            )

    schema = with_doc_id(docs, "n_words bigint, hits array<array<bigint>>, items array<string>")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any benchmark window; all columns pass through.

    The whole row rides along as the id, so nothing is joined, and rows may repeat or lack an id.
    """
    packed = docs.select(F.struct("*").alias("doc_id"), "text")
    return find_contamination(packed, benchmark).filter(F.size("hits") == 0).select("doc_id.*")

