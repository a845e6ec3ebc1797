"""Shard tars as rows: member index, member scan, context decode."""

from __future__ import annotations

import tarfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from ctxloom.runtime import parallelism, ship_package
from ctxloom.sources.listing import list_sized, resolve_inputs
from ctxloom.sources.manifest import found_manifests
from ctxloom.sources.paths import codec_of, is_local, open_bytes

TAR_SUFFIX = "tar"
RANGE_SCHEMA = "src string, first bigint, start bigint, end bigint, members bigint"
MEMBER_SCHEMA = "src string, pos bigint, name string, payload binary"
_RANGE_BYTES = 128 << 20
_FLUSH_BYTES = 16 << 20
# A local seek costs less than the bytes between two headers; to an object store each read is a request.
_HEADER_READ = 1024
# A tar up to this size is one task's work, so its member count is all that must be known beforehand.
_WHOLE_BYTES = 1 << 30


def _open_tar(stream, seekable: bool) -> tarfile.TarFile:
    """A compressed tar is read front to back; a plain one can be entered at any member."""
    return tarfile.open(fileobj=stream, mode="r:" if seekable else "r|")


def _plain_header(block: bytes) -> tuple[str, int] | None:
    """(name, size) of a regular file whose one header block says all, else None: that is for ``tarfile`` to read."""
    size, checksum = block[124:135], block[148:156].strip(b" \0")
    if len(block) != tarfile.BLOCKSIZE or block[156:157] != tarfile.REGTYPE or block[345] or not size.isdigit():
        return None
    name = block[:100].split(b"\0", 1)[0]
    if block[135:136] not in b" \0" or not name.isascii() or not checksum.isdigit():
        return None
    try:
        if int(checksum, 8) != 256 + sum(block[:148]) + sum(block[156:]):
            return None
        return name.decode(), int(size, 8)
    except ValueError:
        return None


def _tar_members(stream, seekable: bool, payloads: bool) -> Iterator[tuple[int, int, str, bytes]]:
    """(offset, end, name, payload) of each member from where the stream stands; an empty payload unless asked for.

    The usual headers are read here, since most of the time of small members goes into them. From the first
    other one on, which may be the end of the archive, ``tarfile`` does the rest.
    """
    at = stream.tell() if seekable else 0
    while seekable and (found := _plain_header(stream.read(tarfile.BLOCKSIZE))) is not None:
        name, size = found
        end = at + tarfile.BLOCKSIZE + -(-size // tarfile.BLOCKSIZE) * tarfile.BLOCKSIZE
        payload = b""
        if payloads:
            payload = stream.read(size)
            rest = end - at - tarfile.BLOCKSIZE - size
            whole = len(payload) + len(stream.read(rest)) == size + rest
        else:
            stream.seek(end - 1)
            whole = len(stream.read(1)) == 1
        if not whole:
            raise tarfile.ReadError("unexpected end of data")
        yield at, end, name, payload
        at = end
    if seekable:
        stream.seek(at)
    tar = _open_tar(stream, seekable)
    while (member := tar.next()) is not None:
        data = tar.extractfile(member) if payloads and member.isreg() else None
        yield member.offset, tar.offset, member.name, data.read() if data is not None else b""
        tar.members = []


def _index_batches(range_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for src in batch.column(0).to_pylist():
                seekable = codec_of(src) is None
                rows, first, start, members, end = [], 0, 0, 0, 0
                small = {"read_bytes": _HEADER_READ} if seekable and is_local(src) else {}
                with open_bytes(src, **small) as stream:
                    for offset, end, _, _ in _tar_members(stream, seekable, payloads=False):
                        if seekable and members and offset - start >= range_bytes:
                            rows.append((src, first, start, offset, members))
                            first, start, members = first + members, offset, 0
                        members += 1
                    if members:
                        rows.append((src, first, start, end, members))
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(("src", "first", "start", "end", "members"), row)) for row in rows], schema=_RANGE_ARROW
                )

    return run


_RANGE_ARROW = pa.schema(
    [("src", pa.string()), ("first", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("members", pa.int64())]
)
_MEMBER_ARROW = pa.schema(
    [("src", pa.string()), ("pos", pa.int64()), ("name", pa.string()), ("payload", pa.binary())]
)


def index_shards(
    spark: SparkSession, paths: list[str] | str, ext: str = TAR_SUFFIX, range_bytes: int = _RANGE_BYTES
) -> DataFrame:
    """(src, first, start, end, members): byte ranges of whole members, a few per large tar.

    Only member headers are read from a plain tar. The ranges let many tasks share one large tar.
    """
    ship_package(spark)
    return _walk(list_sized(spark, paths, ext), range_bytes)


def _walk(files: DataFrame, range_bytes: int) -> DataFrame:
    return files.select("file").mapInArrow(_index_batches(range_bytes), RANGE_SCHEMA)


def count_shards(
    spark: SparkSession, paths: list[str] | str, ext: str = TAR_SUFFIX, range_bytes: int = _RANGE_BYTES,
    whole_bytes: int = _WHOLE_BYTES,
) -> DataFrame:
    """The ranges of ``index_shards``, without opening a tar that a manifest in its folder counts.

    Such a tar is one range. Tars over ``whole_bytes``, tars that no manifest names (or two lines name
    differently), and inputs given file by file are walked. ``read_ranges`` checks every count while reading.
    """
    ship_package(spark)
    files = list_sized(spark, paths, ext)
    folders = resolve_inputs(spark, paths, ext).dirs
    if not folders:
        return _walk(files, range_bytes)
    stem = F.regexp_replace("file", r"\.[^/]*$", "")
    told = files.select("file", "bytes", stem.alias("stem")).join(found_manifests(spark, list(folders)), "stem", "left")
    trusted = F.coalesce((F.col("bytes") <= whole_bytes) & (F.col("members") > 0), F.lit(False))
    zero = F.lit(0).cast("bigint")
    whole = told.filter(trusted).select(
        F.col("file").alias("src"), zero.alias("first"), zero.alias("start"), zero.alias("end"), "members"
    )
    return whole.unionByName(_walk(told.filter(~trusted), range_bytes))


def _member_batch(cols: list[list]) -> pa.RecordBatch:
    arrays = [pa.array(values, kind) for values, kind in zip(cols, _MEMBER_ARROW.types)]
    return pa.RecordBatch.from_arrays(arrays, schema=_MEMBER_ARROW)


def _read_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cols: list[list] = [[], [], [], []]
    held = 0
    for batch in batches:
        for src, first, start, end, members in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            seekable = codec_of(src) is None
            with open_bytes(src) as stream:
                if seekable:
                    stream.seek(start)
                pos = first
                for offset, _, name, payload in _tar_members(stream, seekable, payloads=True):
                    if seekable and end and offset >= end:
                        break
                    for col, value in zip(cols, (src, pos, name, payload)):
                        col.append(value)
                    pos, held = pos + 1, held + len(payload)
                    if held >= _FLUSH_BYTES:
                        yield _member_batch(cols)
                        cols, held = [[], [], [], []], 0
            if members is not None and pos - first != members:
                raise ValueError(f"{members} members were counted and {pos - first} read: {src}, from byte {start}")
    yield _member_batch(cols)


def read_ranges(ranges: DataFrame) -> DataFrame:
    """(src, pos, name, payload) of indexed ranges, spread over tasks range by range.

    A range that has not as many members as it says stops the job.
    """
    ship_package(ranges.sparkSession)
    spread = ranges.select("src", "first", "start", "end", "members").repartition(parallelism(ranges.sparkSession))
    return spread.mapInArrow(_read_members, MEMBER_SCHEMA)


def read_shards(spark: SparkSession, paths: list[str] | str, ext: str = TAR_SUFFIX) -> DataFrame:
    """(src, pos, name, payload): every member of every tar, payload untouched.

    A tar is streamed member by member, so its size is no matter; tars are shared out by bytes.
    """
    ship_package(spark)
    zero = F.lit(0).cast("bigint")
    whole = list_sized(spark, paths, ext).select(
        F.col("file").alias("src"), zero.alias("first"), zero.alias("start"), zero.alias("end"),
        F.lit(None).cast("bigint").alias("members"),
    )
    return whole.mapInArrow(_read_members, MEMBER_SCHEMA)


@arrow_udf(T.StringType())
def _inflate(payloads: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in payloads:
        yield pa.array([zlib.decompress(p, 31).decode() for p in batch.to_pylist()], pa.string())


def decode_contexts(shards: DataFrame) -> DataFrame:
    """Replace ``payload`` by ``tokens``; a payload that is no list of ids stops the job."""
    ship_package(shards.sparkSession)
    tokens = F.from_json(_inflate("payload"), "array<int>", {"mode": "FAILFAST"})
    return shards.withColumn("tokens", tokens).drop("payload")
