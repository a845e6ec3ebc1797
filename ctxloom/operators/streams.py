"""Block streams: the job-scale way to pack.

Each file block is encoded, framed and cut into rows of one context length counted from the block's
own start, all in one pass without a shuffle. Once the block totals are known, such a row maps onto
at most two contexts of the file. Rows are small whatever the documents' sizes, and only narrow
totals take part in the running sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ctxloom.functions.arith import int_div
from ctxloom.functions.presets import Preset
from ctxloom.operators.encode import Vocab, token_lists
from ctxloom.operators.offsets import ROWS_PER_RANGE, named, range_bases
from ctxloom.operators.packing import check_positive, join_pieces, pad_pieces
from ctxloom.runtime import ship_package

STREAM_SCHEMA = "file string, block bigint, seq bigint, docs bigint, n int, tokens array<int>"
REJECT_SCHEMA = "ord bigint, reason string"
_FLUSH_TOKENS = 1 << 20


def arrange_blocks(df: DataFrame, rows_per_block: int = 4096, block: Column | None = None) -> DataFrame:
    """Lay a table (file, ord, ...) out as blocks: one task has each block whole and in order.

    A file scan needs no arranging. Use this for tables, and to spread a huge compressed file that
    one task had to read. ``block`` must follow the order of ``ord``; by default it is a range of it.
    """
    block = int_div("ord", rows_per_block) if block is None else block
    return df.withColumn("block", block).repartition("file", "block").sortWithinPartitions("file", "block", "ord")


class _Cutter:
    """Concatenates the documents of one block and cuts rows of ``size`` ids."""

    def __init__(self, size: int):
        self.size = size
        self.rows: list[tuple[str, int, int, int]] = []
        self.arrays: list[np.ndarray] = []
        self.rejects: list[tuple[str, int, int, str]] = []
        self.pending = 0
        self._open(None)

    def _open(self, key) -> None:
        self.key, self.seq, self.docs, self.held, self.parts = key, 0, 0, 0, []

    def add(self, key, ids: list[np.ndarray]) -> None:
        if key != self.key:
            self.close()
            self._open(key)
        self.parts += ids
        self.held += sum(len(part) for part in ids)
        self.docs += 1
        if self.held >= self.size:
            stream = np.concatenate(self.parts)
            whole = len(stream) - len(stream) % self.size
            for lo in range(0, whole, self.size):
                self._emit(stream[lo : lo + self.size])
            self.parts, self.held = [stream[whole:]], len(stream) - whole

    def close(self) -> None:
        if self.held:
            self._emit(np.concatenate(self.parts))

    def _emit(self, row: np.ndarray) -> None:
        self.rows.append((*self.key, self.seq, self.docs))
        self.arrays.append(row)
        self.pending += len(row)
        self.seq, self.docs = self.seq + 1, 0

    def reject(self, file, block, ord, reason) -> None:
        """A row of its own that belongs to no stream."""
        self.rejects.append((file, block, ord, reason))
        self.pending += 1

    def drain(self, with_rejects: bool = False) -> pa.RecordBatch:
        cols = list(zip(*self.rows)) or [(), (), (), ()]
        batch = pa.RecordBatch.from_arrays(
            [
                pa.array(cols[0], pa.string()),
                pa.array(cols[1], pa.int64()),
                pa.array(cols[2], pa.int64()),
                pa.array(cols[3], pa.int64()),
                pa.array([len(row) for row in self.arrays], pa.int32()),
                token_lists(self.arrays),
            ],
            names=["file", "block", "seq", "docs", "n", "tokens"],
        )
        if with_rejects:
            batch = self._beside(batch)
        self.rows, self.arrays, self.rejects, self.pending = [], [], [], 0
        return batch

    def _beside(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        """The stream's rows, then those of the rejected records."""
        names, m, n = [*batch.schema.names, "ord", "reason"], batch.num_rows, len(self.rejects)
        cols = list(zip(*self.rejects)) or [(), (), (), ()]
        given = {"file": cols[0], "block": cols[1], "ord": cols[2], "reason": cols[3]}
        kinds = dict(zip(names, [*batch.schema.types, pa.int64(), pa.string()], strict=True))
        own = {c: batch.column(c) if c in batch.schema.names else pa.nulls(m, kinds[c]) for c in names}
        added = {c: pa.array(given[c], kinds[c]) if c in given else pa.nulls(n, kinds[c]) for c in names}
        return pa.RecordBatch.from_arrays([pa.concat_arrays([own[c], added[c]]) for c in names], names=names)


def block_streams(df: DataFrame, preset: Preset, seqlen: int, vocab: Vocab | None = None) -> DataFrame:
    """(file, block, seq, docs, n, tokens) from documents (file, block, [ord], text or tokens).

    Rows must reach each task in order, blocks whole: straight from a file scan or by
    ``arrange_blocks``. With a vocabulary ``text`` is encoded here, in the same pass. ``docs`` counts
    documents that began since the row before. A null name is an error.

    With a column ``reason`` (and ``ord``) rows that have one are rejected records: they enter no stream
    and come out beside them in the same pass, as rows of (file, block, ord, reason) and nulls.
    """
    check_positive(seqlen=seqlen)
    ship_package(df.sparkSession)
    head = [] if preset.bos is None else [np.array([preset.bos], dtype=np.int32)]
    tail = [np.array([preset.eot], dtype=np.int32)]
    column = "tokens" if vocab is None else "text"
    rejecting = "reason" in df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None if vocab is None else vocab.encoder()
        cutter = _Cutter(seqlen)
        for batch in batches:
            files, blocks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            values = batch.column(2)
            reasons = batch.column("reason").to_pylist() if rejecting else [None] * batch.num_rows
            for i in range(batch.num_rows):
                if reasons[i] is not None:
                    cutter.reject(files[i], blocks[i], batch.column("ord")[i].as_py(), reasons[i])
                    continue
                if encode is None:
                    ids = values[i].values.to_numpy(zero_copy_only=False).astype(np.int32, copy=False)
                else:
                    ids = encode(values[i].as_py())
                cutter.add((files[i], blocks[i]), head + [ids] + tail)
                if cutter.pending >= _FLUSH_TOKENS:
                    yield cutter.drain(rejecting)
        cutter.close()
        yield cutter.drain(rejecting)

    beside = ["ord", "reason"] if rejecting else []
    schema = f"{STREAM_SCHEMA}, {REJECT_SCHEMA}" if rejecting else STREAM_SCHEMA
    return named(df).select("file", "block", column, *beside).mapInArrow(run, schema)


def split_rejects(stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(streams, rejects (file, block, ord, reason)) of stored block streams that hold both.

    The rejects are read from their own columns alone, and only from where the file has any.
    """
    streams = stored.filter("reason is null").select(*[c.split()[0] for c in STREAM_SCHEMA.split(", ")])
    return streams, stored.filter("reason is not null").select("file", "block", "ord", "reason")


def block_totals(streams: DataFrame) -> DataFrame:
    """(file, block, total, docs), checking that every block came whole from one task."""
    totals = streams.groupBy("file", "block").agg(
        F.sum("n").cast("bigint").alias("total"),
        F.sum("docs").cast("bigint").alias("docs"),
        F.count(F.lit(1)).alias("_rows"),
        F.max("seq").alias("_last"),
    )
    broken = F.concat_ws(" ", F.lit("block was split over tasks:"), "file", F.col("block").cast("string"))
    total = F.when(F.col("_rows") == F.col("_last") + 1, F.col("total")).otherwise(F.raise_error(broken).cast("bigint"))
    return totals.select("file", "block", total.alias("total"), "docs")


def stream_pieces(
    streams: DataFrame, totals: DataFrame, seqlen: int, broadcast: bool = False, depth: int = 0
) -> DataFrame:
    """(file, ctx, offset, tokens): each row cut at the one context border it can hold.

    ``totals`` has a row per block; broadcast it only after checking its size. ``depth`` adds levels
    of block ranges to the running sum, for tables whose sparse ids give a file very many blocks.
    """
    ranges = [f"_r{i}" for i in range(depth, 0, -1)]
    bases = totals.select("file", "block", "total")
    for i in range(1, depth + 1):
        bases = bases.withColumn(f"_r{i}", int_div("block", ROWS_PER_RANGE**i))
    bases = range_bases(bases, ["file", *ranges, "block"]).drop(*ranges)
    placed = streams.join(F.broadcast(bases) if broadcast else bases, ["file", "block"])
    at = F.col("base") + F.col("seq") * seqlen
    size = F.col("n")
    used = F.pmod(at, F.lit(seqlen)).cast("int")
    first = F.least(size, F.lit(seqlen) - used)
    placed = placed.select(
        "file", "tokens", int_div(at, seqlen).alias("_ctx"), used.alias("_used"), first.alias("_first"), size.alias("_size")
    )
    head = F.struct(
        F.col("_ctx").alias("ctx"),
        F.col("_used").alias("offset"),
        F.slice("tokens", F.lit(1), F.col("_first")).alias("tokens"),
    )
    rest = F.struct(
        (F.col("_ctx") + 1).alias("ctx"),
        F.lit(0).alias("offset"),
        F.slice("tokens", F.col("_first") + 1, F.col("_size") - F.col("_first")).alias("tokens"),
    )
    both = F.when(F.col("_size") > F.col("_first"), F.array(head, rest)).otherwise(F.array(head))
    return placed.select("file", F.explode(both).alias("p")).select("file", "p.ctx", "p.offset", "p.tokens")


def pack_streams(
    streams: DataFrame, seqlen: int, pad: int, files: DataFrame | None = None, totals: DataFrame | None = None,
    depth: int = 0,
) -> DataFrame:
    """Contexts (file, ctx, n_real, tokens) of block streams."""
    totals = block_totals(streams) if totals is None else totals
    per_file = totals.groupBy("file").agg(F.sum("total").cast("bigint").alias("total"))
    pieces = stream_pieces(streams, totals, seqlen, depth=depth).withColumn("is_pad", F.lit(False))
    return join_pieces(pieces.unionByName(pad_pieces(per_file, seqlen, pad, files)))
