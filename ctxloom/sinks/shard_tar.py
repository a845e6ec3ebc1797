"""The ``shardtar`` sink: one tar per shard, and the manifest on commit.

A job claims its folder by a marker that names it, writes shards, then the manifest, then takes the marker
away. So a folder is complete (a manifest), left behind by a job that failed (a marker alone) or none of
ours. The next job takes over what was left behind and begins by clearing it away.
"""

from __future__ import annotations

import io
import json
import tarfile
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ctxloom.runtime import ship_package
from ctxloom.sources.manifest import MANIFEST_NAME
from ctxloom.sources.paths import open_fs, qualified, read_small, write_small

FORMAT = "shardtar"
# With default sizes about 4 GB of ids, sorted with spilling; more shards mean more tasks.
SHARDS_PER_TASK = 64
MARKER = "_unfinished"
_PARTIAL = ".shard_"


@dataclass
class ShardCounts(WriterCommitMessage):
    """Shards a task wrote and their members, as packed int64."""

    shards: bytes
    counts: bytes


def gzip_json(parts: list[str]) -> bytes:
    """Payload of a context: gzip of a JSON array, with no timestamp so reruns give the same bytes."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(f"[{','.join(parts)}]".encode()) + packer.flush()


def _renames(system: pafs.FileSystem) -> bool:
    """Whether a file can be moved at no cost and at once. Object stores copy, but show nothing of an object before its end."""
    if isinstance(system, pafs.SubTreeFileSystem):
        return _renames(system.base_fs)
    return system.type_name in ("local", "hdfs", "mock")


_BLANK = bytearray(tarfile.TarInfo("").tobuf(tarfile.GNU_FORMAT))
_BLANK[100:108] = b"0000644\0"
_BLANK[148:156] = b" " * 8
_BLANK_SUM = sum(_BLANK) - sum(_BLANK[124:136])
_WRITE_BYTES = 1 << 20


def member_header(name: str, size: int) -> bytes:
    """The header of a regular file, as ``tarfile`` writes it but in a tenth of the time where one block says all."""
    raw = name.encode("ascii", "replace")
    if len(raw) > tarfile.LENGTH_NAME or not name.isascii() or size >= 8**11:
        info = tarfile.TarInfo(name)
        info.size, info.mode = size, 0o644
        return info.tobuf(tarfile.GNU_FORMAT)
    block, digits = bytearray(_BLANK), b"%011o\0" % size
    block[: len(raw)] = raw
    block[124:136] = digits
    block[148:156] = b"%06o\0 " % (_BLANK_SUM + sum(raw) + sum(digits))
    return bytes(block)


class _OpenShard:
    """A tar being written. It appears under its name only when complete.

    Where files can be renamed it is written under another name first. An object store gets the whole shard
    in one write under its final name; a shard is held in memory for that.
    """

    def __init__(self, folder: str, shard: int, job: str):
        self.shard, self.count, self.folder, self.job = shard, 0, folder, job
        self.system, inner = open_fs(folder)
        self.final = f"{inner}/shard_{shard:08d}.tar"
        self.temp = f"{inner}/{_PARTIAL}{shard:08d}.{job}.{uuid.uuid4().hex}" if _renames(self.system) else None
        self.out = self.system.open_output_stream(self.temp, compression=None) if self.temp else io.BytesIO()
        self.held, self.size = [], 0

    def _put(self, data: bytes) -> None:
        self.held.append(data)
        self.size += len(data)

    def _flush(self) -> None:
        self.out.write(b"".join(self.held))
        self.held = []

    def add(self, name: str, payload: bytes) -> None:
        before = self.size // _WRITE_BYTES
        self._put(member_header(f"{self.shard:08d}_{self.count:08d}_{name}", len(payload)))
        self._put(payload)
        self._put(bytes(-len(payload) % tarfile.BLOCKSIZE))
        self.count += 1
        if self.size // _WRITE_BYTES > before:
            self._flush()

    def close(self) -> None:
        self._put(bytes(2 * tarfile.BLOCKSIZE))
        self._put(bytes(-self.size % tarfile.RECORDSIZE))
        self._flush()
        check_claim(self.folder, self.job)
        if self.temp is None:
            with self.system.open_output_stream(self.final, compression=None) as out:
                out.write(self.out.getbuffer())
            return
        self.out.close()
        try:
            self.system.move(self.temp, self.final)
        except OSError:
            # Not every file system moves over an existing file; an earlier attempt wrote the same bytes.
            if self.system.get_file_info(self.final).type != pafs.FileType.File:
                raise
            self.system.delete_file(self.temp)

    def discard(self) -> None:
        """Leave nothing of a shard that cannot be finished."""
        self.out.close()
        if self.temp is not None and self.system.get_file_info(self.temp).type == pafs.FileType.File:
            self.system.delete_file(self.temp)


# ---------------------------------------------------------------- whose folder it is


def _names(folder: str) -> list[str]:
    system, inner = open_fs(folder)
    if system.get_file_info(inner).type == pafs.FileType.NotFound:
        return []
    return [f.base_name for f in system.get_file_info(pafs.FileSelector(inner))]


def check_unused(folder: str) -> None:
    """Raise unless a job may write here: into a folder without shards, or one that a failed job left behind."""
    names = _names(folder)
    if MANIFEST_NAME in names:
        raise FileExistsError(f"output already holds shards: {folder}")
    if MARKER not in names and any(name.startswith("shard_") for name in names):
        raise FileExistsError(f"output holds shards that no job of ours left behind: {folder}")


def claim(folder: str, job: str) -> None:
    """Mark the folder as this job's, and clear away what a failed one left there."""
    check_unused(folder)
    system, inner = open_fs(folder)
    system.create_dir(inner, recursive=True)
    write_small(f"{folder}/{MARKER}", job.encode())
    for name in _names(folder):
        if name.startswith(("shard_", _PARTIAL)):
            system.delete_file(f"{inner}/{name}")


def check_claim(folder: str, job: str) -> None:
    """Raise if another job has taken the folder over. Every shard is shown only after this check."""
    system, inner = open_fs(folder)
    if system.get_file_info(f"{inner}/{MARKER}").type != pafs.FileType.File or read_small(f"{folder}/{MARKER}") != job.encode():
        raise RuntimeError(f"another job has taken over {folder}")


class ShardTarWriter(DataSourceArrowWriter):
    """Takes rows sorted by shard and member order, each shard in one task.

    Columns: ``shard``, ``name`` and either ``payload`` (one row per member) or ``ids`` and ``n``:
    comma-separated ids and their number, where rows in turn with one name are pieces of a context.
    A task attempt that is run twice writes the same bytes under the same names, so retries and
    speculation are harmless. The manifest is the mark of a complete output.
    """

    def __init__(self, folder: str, fields: list[str], seqlen: int | None, job: str):
        self.folder, self.seqlen, self.job = folder, seqlen, job
        self.pieces = "ids" in fields
        if not {"shard", "name", *(["ids", "n"] if self.pieces else ["payload"])} <= set(fields):
            raise ValueError("shardtar needs the columns shard, name and payload, or shard, name, ids and n")
        claim(folder, job)

    def _members(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str, bytes]]:
        if not self.pieces:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("shard", "name", "payload")))
            return
        rows = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("shard", "name", "ids", "n"))))
        for (shard, name), group in groupby(rows, key=lambda row: row[:2]):
            parts, size = [], 0
            for _, _, ids, n in group:
                parts.append(ids)
                size += n
            if self.seqlen is not None and size != self.seqlen:
                raise ValueError(f"context {name} of shard {shard} has {size} ids, not {self.seqlen}")
            yield shard, name, gzip_json(parts)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> ShardCounts:
        written: dict[int, int] = {}
        target: _OpenShard | None = None
        try:
            for shard, name, payload in self._members(iterator):
                if target is None or target.shard != shard:
                    if target is not None:
                        target.close()
                        written[target.shard] = target.count
                    if shard in written:
                        raise ValueError(f"rows of shard {shard} are not together")
                    target = _OpenShard(self.folder, shard, self.job)
                target.add(name, payload)
            if target is not None:
                target.close()
                written[target.shard] = target.count
        except BaseException:
            if target is not None:
                target.discard()
            raise
        ids = np.fromiter(written.keys(), dtype=np.int64, count=len(written))
        counts = np.fromiter(written.values(), dtype=np.int64, count=len(written))
        return ShardCounts(ids.tobytes(), counts.tobytes())

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        got = [m for m in messages if m is not None]
        ids = np.concatenate([np.frombuffer(m.shards, dtype=np.int64) for m in got] or [np.empty(0, np.int64)])
        counts = np.concatenate([np.frombuffer(m.counts, dtype=np.int64) for m in got] or [np.empty(0, np.int64)])
        order = np.argsort(ids)
        ids, counts = ids[order], counts[order]
        if len(np.unique(ids)) != len(ids):
            raise ValueError("a shard was written by two tasks; partition the rows by shard")
        lines = (
            json.dumps({"num_sequences": int(n), "shard": f"shard_{int(i):08d}"}, separators=(",", ":"))
            for i, n in zip(ids, counts)
        )
        check_claim(self.folder, self.job)
        system, inner = open_fs(self.folder)
        there = _names(self.folder)
        shards = {f"shard_{int(i):08d}.tar" for i in ids}
        if strange := {name for name in there if name.startswith("shard_")} ^ shards:
            raise RuntimeError(f"shards missing or of another job in {self.folder}: {sorted(strange)[:3]}")
        for name in there:
            if name.startswith(_PARTIAL):  # of attempts that died; all tasks are over
                system.delete_file(f"{inner}/{name}")
        write_small(f"{self.folder}/{MANIFEST_NAME}", "\n".join(lines).encode())
        system.delete_file(f"{inner}/{MARKER}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Nothing to undo: the marker stays, and the next job into this folder clears it."""


class ShardTarSource(DataSource):
    """``df.write.format("shardtar").mode("append").save(folder)``"""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("shardtar does not overwrite; give a new folder")
        seqlen = self.options.get("seqlen")
        job = self.options.get("job") or uuid.uuid4().hex
        return ShardTarWriter(self.options["path"].rstrip("/"), schema.fieldNames(), int(seqlen) if seqlen else None, job)


def write_shards(
    df: DataFrame, folder: str, order: tuple[str, ...] = ("name",), shards: int | None = None, seqlen: int | None = None
) -> None:
    """Write rows (shard, name, payload | tokens) as tars, members sorted by ``order``.

    Ids become text in the JVM, after the shuffle; the Python side only packs.

    Rows go to their task by shard number, so tasks differ by at most one shard. ``shards``, when
    known, sizes the tasks.
    """
    spark: SparkSession = df.sparkSession
    ship_package(spark)
    folder = qualified(spark, folder)
    check_unused(folder)
    spark.dataSource.register(ShardTarSource)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if shards is not None:
        tasks = max(1, min(shards, max(tasks, -(-shards // SHARDS_PER_TASK))))
    if "tokens" in df.columns:
        values = [F.array_join(F.col("tokens").cast("array<string>"), ",").alias("ids"), F.size("tokens").alias("n")]
    else:
        values = [F.col("payload")]
    placed = df.repartitionById(tasks, F.pmod("shard", F.lit(tasks)).cast("int"))
    ready = placed.sortWithinPartitions("shard", *order).select("shard", "name", *values)
    writer = ready.write.format(FORMAT).mode("append").option("job", uuid.uuid4().hex)
    if seqlen is not None:
        writer = writer.option("seqlen", str(seqlen))
    writer.save(folder)
