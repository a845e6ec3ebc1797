"""Removal of long repeated passages: suffixes are keyed and compared bucket by bucket, pruned by a difference-cover sample.

A suffix matters here only by its first LENGTH bytes: it is repeated if another suffix begins with the same
ones. All suffixes of a large corpus cannot be shuffled, so the work is blockwise:

1. Cover sample. Places p of a document with p mod 133 in a difference cover have a 68-byte window each,
   which goes to the bucket its hash names. For any two places i, j there is a shift below 133 that takes
   both into the sample, so every suffix that is repeated has a repeated sample window in its reach.
2. Suffixes with such a window in reach go to buckets too, by two hashes of their first 200 bytes. One bucket
   at a time is sorted; equal neighbours are repeated.

A bucket holds about as many entries whatever the corpus' size, since the number of buckets grows with it,
and a block of documents sends an entry once, however often it has it.
"""

from __future__ import annotations

import hashlib
import secrets
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from ctxloom.llm.common import bucketed_by_block, rows_of, stored, with_doc_id
from ctxloom.runtime import ship_package

LENGTH = 200
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 6 << 20  # of text, for each bucket
PERIOD = 133
# Fixed value: differences of these, mod 133, are all numbers below 133.
COVER = (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109)
_SEGMENT = 1 << 18
_PRIME = (1 << 31) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """``n`` powers of the base modulo the prime, from the zeroth on."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), _PRIME)) % np.uint64(_PRIME)])
    return out[:n]


def _fold(x: np.ndarray) -> np.ndarray:
    """A smaller number of the same residue."""
    return (x & np.uint64(_PRIME)) + (x >> np.uint64(31))


class WindowHashes:
    """Two 64-bit hashes of byte windows, from three polynomials of their bytes modulo a prime.

    The polynomials are taken at places drawn anew for each run from ``seed``, which nobody knows beforehand.
    Two different windows are polynomials that agree at fewer than LENGTH places, so that all three residues are
    equal with a probability under (LENGTH / 2**31)**3, or 2**-70, however the texts were chosen; the first
    hash keeps 64 bits of the residues.
    """

    def __init__(self, seed: int) -> None:
        n = _SEGMENT + 2 * LENGTH
        draw = np.random.default_rng(seed)
        self.of_byte = np.arange(256, dtype=np.uint64) + draw.integers(1, _PRIME - 256, dtype=np.uint64)
        bases = [int(b) for b in draw.integers(2, _PRIME - 1, 3)]
        self.powers = [_powers(b, n) for b in bases]
        self.inverse = [_powers(pow(b, -1, _PRIME), n) for b in bases]
        self.salts = draw.integers(0, 1 << 64, 3, np.uint64) | np.uint64(1)

    def residues(self, data: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
        """(3, starts): each window's three residues, for the ascending ``starts``."""
        out = np.empty((3, len(starts)), np.uint64)
        for at in range(0, len(data), _SEGMENT):
            a, b = np.searchsorted(starts, [at, at + _SEGMENT])
            if a == b:
                continue
            values = self.of_byte[data[at : at + _SEGMENT + width]]
            own = starts[a:b] - at
            for k in range(3):
                sums = np.zeros(len(values) + 1, np.uint64)
                np.cumsum(_fold(values * self.powers[k][: len(values)]), out=sums[1:])
                out[k, a:b] = _fold(_fold(sums[own + width] - sums[own])) * self.inverse[k][own] % np.uint64(_PRIME)
        return out

    def at(self, data: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of ``data[s : s + width]`` for the ascending ``starts``."""
        one, two, three = self.residues(data, starts, width)
        pair = one | (two << np.uint64(31))
        return _mix(_mix(pair ^ self.salts[0]) + three * self.salts[1]), _mix(three + two * self.salts[2])


# ---------------------------------------------------------------- blocks of documents


def _pack(docs: DataFrame, block_bytes: int) -> DataFrame:
    """(block, ids, sizes, hashes, data): whole documents, their bytes compressed together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        kind = None
        ids: list = []
        own: list[bytes] = []

        def row() -> pa.RecordBatch:
            digests = [hashlib.blake2b(d, digest_size=32).hexdigest() if len(d) >= LENGTH else "" for d in own]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([uuid.uuid4().hex]), pa.array([ids], pa.list_(kind)),
                    pa.array([[len(d) for d in own]], pa.list_(pa.int64())), pa.array([digests], pa.list_(pa.string())),
                    pa.array([squeeze.compress(b"".join(own))], pa.binary()),
                ],
                ["block", "ids", "sizes", "hashes", "data"],
            )

        total = 0
        for batch in batches:
            kind = batch.column("doc_id").type
            for doc_id, text in rows_of(batch):
                ids.append(doc_id)
                own.append(text.encode("utf-8", "replace"))
                total += len(own[-1])
                if total >= block_bytes:
                    yield row()
                    ids, own, total = [], [], 0
        if ids:
            yield row()

    ids = StructField("ids", ArrayType(docs.schema["doc_id"].dataType))
    rest = StructType.fromDDL("block string, sizes array<bigint>, hashes array<string>, data binary").fields
    schema = StructType([rest[0], ids, *rest[1:]])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


class _Block:
    """One block's bytes and places."""

    def __init__(self, row: dict, hashes: WindowHashes, n_buckets: int) -> None:
        raw = zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=max(1, sum(row["sizes"])))
        self.data = np.frombuffer(raw, np.uint8)
        self.sizes = np.array(row["sizes"], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.begins = self.ends - self.sizes
        self.copies, self.heads = set(row["copies"] or ()), set(row["heads"] or ())
        self.answers = {(a["step"], a["bucket"]): a["bits"] for a in row["answers"] or ()}
        self.hashes, self.n_buckets = hashes, n_buckets

    def samples(self) -> np.ndarray:
        """Starts of the sample windows of all documents long enough, without further copies of a text."""
        reach = LENGTH - PERIOD + 1
        cover = np.array(COVER)
        parts = []
        for k in range(len(self.sizes)):
            if self.sizes[k] < LENGTH or k in self.copies:
                continue
            last = int(self.sizes[k]) - reach
            places = (np.arange(0, last + 1, PERIOD)[:, None] + cover).ravel()
            parts.append(places[places <= last] + self.begins[k])
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def entries(self, starts: np.ndarray, width: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(bucket, key) of each start."""
        first, second = self.hashes.at(self.data, starts, width)
        return (second >> np.uint64(32)).astype(np.int64) % self.n_buckets, first >> np.uint64(64 - bits)

    def repeated(self, step: int, buckets: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Which of the entries occur elsewhere, here or in another block, by the buckets' answers."""
        out = np.zeros(len(keys), bool)
        order = np.lexsort((keys, buckets))
        for bucket, own in _runs(buckets, order):
            unique, which, counts = np.unique(keys[own], return_inverse=True, return_counts=True)
            bits = np.unpackbits(np.frombuffer(self.answers[step, bucket], np.uint8), count=len(unique)).astype(bool)
            out[own] = (bits | (counts > 1))[which]
        return out

    def candidates(self) -> np.ndarray:
        """Starts of suffixes that have a repeated sample window in reach."""
        starts = self.samples()
        found = starts[self.repeated(1, *self.entries(starts, LENGTH - PERIOD + 1, 32))]
        doc = np.searchsorted(self.ends, found, side="right")
        reach = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(reach, np.maximum(found - (PERIOD - 1), self.begins[doc]), 1)
        np.add.at(reach, np.minimum(found, self.ends[doc] - LENGTH) + 1, -1)
        return np.nonzero(np.cumsum(reach[:-1]) > 0)[0]

    def removed(self) -> np.ndarray:
        """Mask of the bytes that a repeated passage covers."""
        starts = self.candidates()
        found = starts[self.repeated(2, *self.entries(starts, LENGTH, 64))]
        cover = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(cover, found, 1)
        np.add.at(cover, found + LENGTH, -1)
        mask = np.cumsum(cover[:-1]) > 0
        for k in self.copies | self.heads:
            mask[self.begins[k] : self.ends[k]] = True
        return mask


def _runs(buckets: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    if len(order):
        borders = np.nonzero(np.diff(buckets[order]))[0] + 1
        for own in np.split(order, borders):
            yield int(buckets[own[0]]), own


# ---------------------------------------------------------------- buckets


def _squeezed(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, one plane of bytes after another."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return zstandard.ZstdCompressor(level=1).compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes())


def _expanded(data: bytes, n: int) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data, max_output_size=8 * n)
    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view("<u8").ravel())


def _send(blocks: DataFrame, step: int, n_buckets: int, seed: int) -> DataFrame:
    """(block, bucket, n, keys): what each block asks each bucket in this step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WindowHashes(seed)
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block(row, hashes, n_buckets)
                if step == 1:
                    buckets, keys = block.entries(block.samples(), LENGTH - PERIOD + 1, 32)
                else:
                    buckets, keys = block.entries(block.candidates(), LENGTH, 64)
                rows = [(b, np.unique(keys[own])) for b, own in _runs(buckets, np.argsort(buckets, kind="stable"))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["block"]] * len(rows), pa.string()), pa.array([b for b, _ in rows], pa.int64()),
                        pa.array([len(k) for _, k in rows], pa.int64()), pa.array([_squeezed(k) for _, k in rows], pa.binary()),
                    ],
                    ["block", "bucket", "n", "keys"],
                )

    return blocks.mapInArrow(run, "block string, bucket bigint, n bigint, keys binary")


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bit for each key of each block: whether another block has it. Rows come sorted by bucket."""
    own: list[tuple[str, np.ndarray]] = []
    now = None

    def settle() -> pa.RecordBatch:
        unique, counts = np.unique(np.concatenate([k for _, k in own]), return_counts=True)
        bits = [np.packbits(counts[np.searchsorted(unique, k)] > 1).tobytes() for _, k in own]
        return pa.RecordBatch.from_arrays(
            [pa.array([b for b, _ in own]), pa.array([now] * len(own), pa.int64()), pa.array(bits, pa.binary())],
            ["block", "bucket", "bits"],
        )

    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != now and own:
                yield settle()
                own = []
            now = row["bucket"]
            own.append((row["block"], _expanded(row["keys"], row["n"])))
    if own:
        yield settle()


def _answers(sent: DataFrame, step: int) -> DataFrame:
    sorted_rows = sent.repartition("bucket").sortWithinPartitions("bucket", "block")
    bits = sorted_rows.mapInArrow(_answer, "block string, bucket bigint, bits binary")
    return stored(bits.select("block", F.lit(step).alias("step"), "bucket", "bits"), "answers")


def _copies(blocks: DataFrame) -> DataFrame:
    """(block, copies, heads): places of documents whose whole text came before, and of the first of such texts."""
    docs = blocks.select("block", F.posexplode("hashes").alias("place", "hash")).filter("hash <> ''")
    groups = docs.groupBy("hash").agg(F.min(F.struct("block", "place")).alias("head"), F.count(F.lit(1)).alias("n"))
    marked = docs.join(groups.filter("n > 1"), "hash").withColumn("is_head", F.col("head") == F.struct("block", "place"))
    return marked.groupBy("block").agg(
        F.collect_list(F.when(~F.col("is_head"), F.col("place"))).alias("copies"),
        F.collect_list(F.when(F.col("is_head"), F.col("place"))).alias("heads"),
    )


def _informed(blocks: DataFrame, copies: DataFrame, answers: list[DataFrame]) -> DataFrame:
    """The blocks with what is known of them."""
    out = blocks.join(copies, "block", "left")
    if not answers:
        nothing = F.lit(None).cast("array<struct<step: int, bucket: bigint, bits: binary>>")
        return out.withColumn("answers", nothing)
    every = answers[0] if len(answers) == 1 else answers[0].unionByName(answers[1])
    per_block = every.groupBy("block").agg(F.collect_list(F.struct("step", "bucket", "bits")).alias("answers"))
    return out.join(per_block, "block", "left")


def remove_repeats(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_bytes, removed, kept): each text without the bytes that a repeated passage of 200 bytes covers.

    ``removed`` are [start, end) byte ranges, maximal and in order; ``kept`` is the rest. Texts are UTF-8
    bytes; passages do not cross documents; all of them are judged on the input, so each occurrence goes,
    the first as well.

    One row per row of ``docs``; null and empty texts have no bytes; texts under 200 bytes stay whole;
    repeated rows are copies of each other. doc_id is only carried along, other columns are not looked at.
    """
    spark = docs.sparkSession
    ship_package(spark)
    # Blocks are named at random, so they are written before a shuffle goes by their names: a task run again reads the same ones.
    packed = stored(_pack(docs, block_bytes), "packed")
    blocks = bucketed_by_block(packed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "block"))
    total = blocks.select(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda n, x: n + x).alias("n")).agg(F.sum("n")).first()[0]
    n_buckets = 1 + (total or 0) // BUCKET_BYTES
    seed = secrets.randbits(128)
    copies = stored(_copies(blocks), "copies")
    first = _answers(_send(_informed(blocks, copies, []), 1, n_buckets, seed), 1)
    second = _answers(_send(_informed(blocks, copies, [first]), 2, n_buckets, seed), 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WindowHashes(seed)
        for batch in batches:
            kind = batch.schema.field("ids").type.value_type
            for row in batch.to_pylist():
                block = _Block(row, hashes, n_buckets)
                mask = block.removed()
                spans, kept = [], []
                for a, b in zip(block.begins.tolist(), block.ends.tolist(), strict=True):
                    own = mask[a:b]
                    edges = np.nonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))[0]
                    spans.append(edges.reshape(-1, 2).tolist())
                    kept.append(block.data[a:b][~own].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["ids"], kind), pa.array(row["sizes"], pa.int64()),
                        pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.binary()),
                    ],
                    ["doc_id", "n_bytes", "removed", "kept"],
                )

    informed = _informed(blocks, copies, [first, second])
    return informed.mapInArrow(run, with_doc_id(docs, "n_bytes bigint, removed array<array<bigint>>, kept binary"))
