"""Byte-level BPE: every distinct word is encoded once, wherever it occurs, and its ids are joined back by place.

Pre-tokens are exploded per block of documents: a block sends each of its distinct words once to the bucket
that the word's hash names, and keeps the words' places. In a bucket all blocks' uses of a word meet, and the
word is merged once. Ids go back to the blocks, which put them together by place. So a frequent word weighs
one entry per block, not one per occurrence.
"""

from __future__ import annotations

import heapq
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, StructField, StructType

from ctxloom.llm.common import bucketed_by_block, release_memory, rows_of, with_doc_id, worker_state
from ctxloom.runtime import ship_package

BLOCK_CHARS = 8 << 20
MAX_VOCABULARY_BYTES = 64 << 20
_PLACES = -1  # the bucket of the row that begins a block's places; the places themselves have those below
_PART = 1 << 18  # places in a row
_REMEMBERED = 1 << 19  # words of a bucket that a worker remembers at once


def check_vocabulary(ranks: dict[bytes, int]) -> dict[bytes, int]:
    """The ranks, if they are complete and small enough to be sent to every executor."""
    if sum(map(len, ranks)) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"a vocabulary of more than {MAX_VOCABULARY_BYTES} bytes is not broadcast")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("every single byte needs a rank")
    return ranks


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: its own, or what is left after merging the pair of lowest rank, leftmost first, again and again."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    n = len(word)
    after, before = list(range(1, n + 2)), list(range(-1, n))
    rank = ranks.get
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, end = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= n or after[j] != end:
            continue
        alive[j] = False
        after[i] = end
        if end < n:
            before[end] = i
            if (r := rank(word[i : after[end]])) is not None:
                heapq.heappush(heap, (r, i, after[end]))
        h = before[i]
        if h >= 0 and (r := rank(word[h:end])) is not None:
            heapq.heappush(heap, (r, h, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : after[i]]])
        i = after[i]
    return out


# ---------------------------------------------------------------- blocks to words and places


class _Numbers(dict):
    """Numbers words by their first use."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def _squeeze(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"".join(a.tobytes() for a in arrays))


def _spread(data: bytes, size: int) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data, max_output_size=max(1, size))


def _planes(codes: np.ndarray) -> np.ndarray:
    return codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.copy()


def _exploded(docs: DataFrame, pattern: str, n_buckets: int, block_chars: int) -> DataFrame:
    """Rows of two kinds: (block, bucket, n, size, data) words for a bucket, and the block's places with its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("words", dict)
        find = regex.compile(pattern).findall
        kind = None
        ids: list = []
        counts: list[int] = []
        codes: list[np.ndarray] = []
        numbers = _Numbers()

        def rows() -> pa.RecordBatch:
            words = [w.encode("utf-8", "replace") for w in numbers]
            buckets = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % n_buckets
            own: list[list[bytes]] = [[] for _ in range(n_buckets)]
            for word, bucket in zip(words, buckets.tolist(), strict=True):
                own[bucket].append(word)
            out = []
            for bucket, mine in enumerate(own):
                if mine:
                    data = [np.array([len(w) for w in mine], "<u4"), np.frombuffer(b"".join(mine), np.uint8)]
                    out.append((bucket, len(mine), sum(a.nbytes for a in data), _squeeze(*data), None, None))
            head = _planes(buckets)
            out.append((_PLACES, len(words), head.nbytes, _squeeze(head), ids, counts))
            flat = np.concatenate(codes) if codes else np.zeros(0, np.uint32)
            for k, at in enumerate(range(0, len(flat), _PART)):
                part = _planes(flat[at : at + _PART])
                out.append((_PLACES - 1 - k, len(part[0]), part.nbytes, _squeeze(part), None, None))
            block = uuid.uuid4().hex
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * len(out)), *(pa.array([r[k] for r in out], pa.int64()) for k in range(3)),
                    pa.array([r[3] for r in out], pa.binary()), pa.array([r[4] for r in out], pa.list_(kind)),
                    pa.array([r[5] for r in out], pa.list_(pa.int64())),
                ],
                ["block", "bucket", "n", "size", "data", "ids", "counts"],
            )

        total = 0
        for batch in batches:
            kind = batch.column("doc_id").type
            for doc_id, text in rows_of(batch):
                found = find(text)
                ids.append(doc_id)
                counts.append(len(found))
                codes.append(np.fromiter(map(numbers.__getitem__, found), np.uint32, len(found)))
                total += len(text)
                if total >= block_chars:
                    yield rows()
                    ids, counts, codes, numbers, total = [], [], [], _Numbers(), 0
        if ids:
            yield rows()
        ids, counts, codes, numbers = [], [], [], _Numbers()
        release_memory()

    ids = StructField("ids", ArrayType(docs.schema["doc_id"].dataType))
    plain = StructType.fromDDL("block string, bucket bigint, n bigint, size bigint, data binary, counts array<bigint>").fields
    schema = StructType([*plain[:5], ids, plain[5]])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


# ---------------------------------------------------------------- words to ids, and back by place


def _encoded_words(words: DataFrame, ranks) -> DataFrame:
    """(block, bucket, n, size, data): for each word of the row the number of its ids, then all ids.

    Rows come sorted by bucket, and the words of one bucket are remembered until the next, or until they are
    too many to keep, whatever the corpus' size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranks.value
        worker_state("words", dict)
        known: dict[bytes, list[int]] = {}
        now = None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                raw = _spread(row["data"], row["size"])
                sizes = np.frombuffer(raw, "<u4", row["n"])
                ends = (np.cumsum(sizes, dtype=np.int64) + 4 * row["n"]).tolist()
                begins = [4 * row["n"], *ends[:-1]]
                if row["bucket"] != now or len(known) > _REMEMBERED:
                    known, now = {}, row["bucket"]
                lists = []
                for a, b in zip(begins, ends, strict=True):
                    word = raw[a:b]
                    own = known.get(word)
                    if own is None:
                        own = known[word] = encode_word(word, table)
                    lists.append(own)
                flat = np.array([i for own in lists for i in own], np.uint32)
                data = [np.array([len(own) for own in lists], "<u4"), _planes(flat)]
                out.append((row["block"], row["bucket"], len(flat), sum(a.nbytes for a in data), _squeeze(*data), row["n"]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in out], pa.string()), *(pa.array([r[k] for r in out], pa.int64()) for k in (1, 2, 3)),
                    pa.array([r[4] for r in out], pa.binary()), pa.array([r[5] for r in out], pa.int64()),
                ],
                ["block", "bucket", "n", "size", "data", "words"],
            )
        known = {}
        release_memory()

    return words.mapInArrow(run, "block string, bucket bigint, n bigint, size bigint, data binary, words bigint")


def _from_planes(raw: bytes, at: int, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n, at).reshape(4, n).T).view("<u4").ravel()


def _unpacked(table: pa.Table, k: int) -> bytes:
    return _spread(table.column("data")[k].as_buffer(), table.column("size")[k].as_py())


def _ids_of_block(places: pa.Table, encoded: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(ids, borders) of a block's documents, from its places and, by bucket, the ids of its words."""
    kinds, lengths = places.column("bucket").to_numpy(), places.column("n").to_numpy()
    order = np.argsort(-kinds)  # the head, then the places part by part
    buckets = _from_planes(_unpacked(places, order[0]), 0, int(lengths[order[0]]))
    codes = np.concatenate([np.zeros(0, np.uint32), *(_from_planes(_unpacked(places, k), 0, int(lengths[k])) for k in order[1:])])
    # Words of a bucket were sent in the order of their numbers.
    by_number = np.argsort(buckets, kind="stable")
    n_words, n_ids = encoded.column("words").to_numpy(), encoded.column("n").to_numpy()
    flat, by_bucket = np.empty(int(n_ids.sum()), np.uint32), np.empty(int(n_words.sum()), np.int32)
    at_word = at_id = 0
    for k in np.argsort(encoded.column("bucket").to_numpy()):
        raw = _unpacked(encoded, k)
        by_bucket[at_word : at_word + n_words[k]] = np.frombuffer(raw, "<u4", n_words[k])
        flat[at_id : at_id + n_ids[k]] = _from_planes(raw, 4 * int(n_words[k]), int(n_ids[k]))
        at_word, at_id = at_word + n_words[k], at_id + n_ids[k]
    begins, sizes = np.empty(len(by_number), np.int64), np.empty(len(by_number), np.int32)
    begins[by_number] = np.cumsum(by_bucket, dtype=np.int64) - by_bucket
    sizes[by_number] = by_bucket
    del buckets, by_bucket, by_number
    counts = np.asarray(places.column("counts")[order[0]].values.to_numpy())
    cuts = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(sizes[codes], out=cuts[1:])
    ids = np.empty(cuts[-1], np.uint32)
    for at in range(0, len(codes), _PART):
        own, cut = codes[at : at + _PART], cuts[at : at + _PART + 1]
        ids[cut[0] : cut[-1]] = flat[np.repeat(begins[own] - cut[:-1], sizes[own]) + np.arange(cut[0], cut[-1])]
    return ids, cuts[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]


def _token_bytes(table) -> pa.Array:
    """The bytes of each token, by its number."""
    name, tokens = table.value
    return worker_state(name, lambda: pa.array(tokens, pa.large_binary()))


def _decoded(ids: pa.Array, borders: np.ndarray, tokens: pa.Array) -> pa.Array:
    """The bytes of each list of ids. One buffer holds them all: nothing is copied list by list."""
    found = tokens.take(ids)
    if not len(found):
        return pa.array([b""] * (len(borders) - 1), pa.binary())
    offsets = np.frombuffer(found.buffers()[1], np.int64)[: len(found) + 1][borders]
    if offsets[-1] >= 1 << 31:
        raise ValueError("more than 2 GB of text in one block")
    return pa.Array.from_buffers(pa.binary(), len(borders) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), found.buffers()[2]])


def _reassembler(tokens):
    """Puts a block's documents together and, given the tokens' bytes, decodes their ids in the same task."""

    def run(places: pa.Table, encoded: pa.Table) -> pa.Table:
        worker_state("words", dict) if tokens is None else _token_bytes(tokens)
        head = places.column("bucket").to_numpy().argmax()
        names = places.column("ids")[int(head)].values
        ids, borders = _ids_of_block(places, encoded)
        del places, encoded
        flat = pa.array(ids.view(np.int32))
        columns = {"doc_id": names, "ids": pa.ListArray.from_arrays(pa.array(borders, pa.int32()), flat)}
        if tokens is not None:
            columns["decoded"] = _decoded(flat, borders, _token_bytes(tokens))
        release_memory()
        return pa.table(columns)

    return run


def _bytes_by_number(docs: DataFrame, ranks: dict[bytes, int]):
    tokens = [b""] * (1 + max(check_vocabulary(ranks).values()))
    for token, rank in ranks.items():
        tokens[rank] = token
    return docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, tokens))


def encode_documents(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, block_chars: int = BLOCK_CHARS, decoded: bool = False
) -> DataFrame:
    """(doc_id, ids): the token ids of each text, without special tokens.

    ``pattern`` finds the words, each merged for itself by ``ranks``. One row per row of ``docs``; null and
    empty texts have no ids; doc_id is only carried along and other columns are not looked at. Words of any
    length are merged in about linear time. ``decoded`` adds what ``decode_documents`` gives, in the task that
    has the ids at hand.
    """
    spark = docs.sparkSession
    ship_package(spark)
    table = spark.sparkContext.broadcast(check_vocabulary(ranks))
    n_buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = bucketed_by_block(_exploded(docs, pattern, n_buckets, block_chars))
    words = pieces.filter("bucket >= 0").select("block", "bucket", "n", "size", "data")
    encoded = _encoded_words(words.repartition("bucket").sortWithinPartitions("bucket"), table)
    places = pieces.filter("bucket < 0").groupBy("block").cogroup(encoded.groupBy("block"))
    tokens = _bytes_by_number(docs, ranks) if decoded else None
    return places.applyInArrow(_reassembler(tokens), with_doc_id(docs, "ids array<int>" + ", decoded binary" * decoded))


def decode_documents(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(doc_id, ids, decoded): the bytes of each row's ids, joined with the table of token bytes.

    The table has one row per token of the vocabulary, a checked size, and goes to every task; the join
    takes a batch of ids at a time. Null ids decode to nothing; an id without token is an error.
    """
    ship_package(encoded.sparkSession)
    table = _bytes_by_number(encoded, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            borders = np.concatenate([[0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), ids, _decoded(ids.flatten(), borders, _token_bytes(table))], ["doc_id", "ids", "decoded"]
            )
        release_memory()

    return encoded.select("doc_id", "ids").mapInArrow(run, with_doc_id(encoded, "ids array<int>, decoded binary"))
