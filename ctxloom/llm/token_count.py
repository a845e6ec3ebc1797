"""Token counts by byte-pair merging with a heap and a linked list; no token ids are made."""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ctxloom.llm.common import texts, with_doc_id, worker_state
from ctxloom.runtime import ship_package

CACHED_WORDS = 1 << 20


def byte_characters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return [chr(b if b in plain else 256 + rest.index(b)) for b in range(256)]


class MergeRules:
    """Merge ranks of a tokenizer.json with word ends, and how it prepares texts."""

    def __init__(self, text: str) -> None:
        spec = json.loads(text)
        model = spec["model"]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or split["behavior"] != "Removed" or not split["invert"]:
            raise ValueError("a tokenizer with NFC, one space for white space, lower case and a split that keeps matches")
        if model["type"] != "BPE" or model["unk_token"] or model["dropout"] or model["ignore_merges"]:
            raise ValueError("a plain BPE model without an unknown token")
        self.pieces = regex.compile(split["pattern"]["Regex"])
        specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.end = model["end_of_word_suffix"] or ""
        ids: dict[str, int] = {}
        number = lambda symbol: ids.setdefault(symbol, len(ids))
        chars = byte_characters()
        self.inner = [number(c) for c in chars]
        self.last = [number(c + self.end) for c in chars]
        #: (left << 32 | right) to (rank << 32 | merged)
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault(number(left) << 32 | number(right), rank << 32 | number(left + right))

    def count_word(self, word: str) -> int:
        """Tokens of one piece: its bytes less the merges made.

        The heap holds (rank, place) of adjacent pairs, so the lowest rank comes first and of equal ranks the
        leftmost. Neighbours are linked both ways; an entry whose pair is gone is skipped.
        """
        data = word.encode("utf-8", "replace")
        n = left = len(data)
        symbols = [self.inner[b] for b in data]
        symbols[-1] = self.last[data[-1]]
        if n == 1:
            return 1
        merges = self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = merges(symbols[i] << 32 | symbols[i + 1])
            if found is not None:
                heap.append((found >> 32, i, found & 0xFFFFFFFF, symbols[i], symbols[i + 1]))
        heapq.heapify(heap)
        while heap:
            _, i, merged, a, b = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = merged, -1
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = merges(merged << 32 | symbols[k])
                if found is not None:
                    heapq.heappush(heap, (found >> 32, i, found & 0xFFFFFFFF, merged, symbols[k]))
            h = before[i]
            if h >= 0:
                found = merges(symbols[h] << 32 | merged)
                if found is not None:
                    heapq.heappush(heap, (found >> 32, h, found & 0xFFFFFFFF, symbols[h], merged))
        return left

    def words(self, text: str) -> list[str]:
        """Pieces of a text without special strings."""
        text = unicodedata.normalize("NFC", text)
        # Lower case character by character: no final sigma.
        return self.pieces.findall(text.replace("Σ", "σ").lower())


class _Counts(dict):
    """Tokens by word; forgets everything when it has grown to ``CACHED_WORDS``."""

    def __init__(self, rules: MergeRules) -> None:
        super().__init__()
        self.rules = rules

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        count = self.rules.count_word(word)
        if len(word) <= 64:
            self[word] = count
        return count


class TokenCounter:
    """Whole texts; special strings inside a text are one token each, as is the library's default."""

    def __init__(self, tokenizer_json: str) -> None:
        self.rules = MergeRules(tokenizer_json)
        self.counts = _Counts(self.rules)

    def count(self, text: str) -> int:
        specials = self.rules.specials
        if specials is None or not specials.search(text):
            return sum(map(self.counts.__getitem__, self.rules.words(text)))
        parts = specials.split(text)
        return len(parts) - 1 + sum(sum(map(self.counts.__getitem__, self.rules.words(p))) for p in parts)


def count_tokens(docs: DataFrame, tokenizer_json: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens), one row per row of ``docs``; ``tokenizer_json`` is the vocabulary file's text.

    Null and empty texts have no bytes and no tokens. Nothing is shuffled: documents stay where they are
    read, and a worker keeps the counts of words it has seen, up to a fixed number. Other columns are not
    looked at, and doc_id may be null or repeat.
    """
    spark = docs.sparkSession
    ship_package(spark)
    vocabulary = spark.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = vocabulary.value
        counter = worker_state(("tokens", hash(text)), lambda: TokenCounter(text))
        for batch in batches:
            own = texts(batch)
            sizes = pa.array([len(t.encode("utf-8", "replace")) for t in own], pa.int64())
            counts = pa.array([counter.count(t) for t in own], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, counts], ["doc_id", "n_bytes", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, with_doc_id(docs, "n_bytes bigint, n_tokens bigint"))
