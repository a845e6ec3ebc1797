"""One spelling per file, and access to file systems from Python tasks."""

from __future__ import annotations

import io
import re

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_READ_BYTES = 4 << 20
_CODECS = {"gz": "gzip", "zst": "zstd", "zstd": "zstd"}
COMPRESSED = r"\.(gz|zst|zstd)$"


def decoded_path(uri: Column) -> Column:
    """Percent-decode a file URI column and write local files as plain paths."""
    plain = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return local_form(plain)


def local_form(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "/")


def normal_path(path: str) -> str:
    """The driver-side counterpart of ``local_form``, without a trailing slash."""
    plain = re.sub(r"^file:/+", "/", path)
    return plain.rstrip("/") or "/"


def qualified(spark: SparkSession, path: str) -> str:
    """Absolute form of a path as its own file system gives it, so driver and tasks mean one place."""
    hadoop_path, system = _hadoop(spark, path)
    return normal_path(system.makeQualified(hadoop_path).toString())


def hadoop_scheme(path: str) -> str:
    """The path for Hadoop's file systems, which know S3 as ``s3a``."""
    return re.sub("^s3://", "s3a://", path)


def literal(path: str) -> str:
    """A path as Spark's readers must be given it to mean that one file or folder and no pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", hadoop_scheme(path))


def is_file(spark: SparkSession, path: str) -> bool:
    hadoop_path, system = _hadoop(spark, path)
    return bool(system.getFileStatus(hadoop_path).isFile())


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(hadoop_scheme(path))
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def common_parent(dirs: list[str], files: list[str]) -> str:
    """Deepest folder that holds all inputs, themselves included if folders; empty if there is none."""
    split = [d.split("/") for d in dirs] + [f.split("/")[:-1] for f in files]
    shared = []
    for parts in zip(*split):
        if len(set(parts)) > 1:
            break
        shared.append(parts[0])
    return "/".join(shared)


def relative_name(file: str, parent: str) -> Column:
    """``file`` below ``parent``. Shuffle keys use this name, so moving a corpus keeps its order."""
    return F.substr(F.col(file), F.lit(len(parent) + 2)) if parent else F.col(file)


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and in-system path for a local path or URI; Hadoop's S3 schemes mean S3."""
    path = re.sub(r"^s3[an]://", "s3://", path)
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), normal_path(path)


def is_local(path: str) -> bool:
    return "://" not in path


def codec_of(path: str) -> str | None:
    return _CODECS.get(path.rsplit(".", 1)[-1])


def open_bytes(path: str, read_bytes: int = _READ_BYTES):
    """Readable stream, decompressed by suffix; a plain file can be sought.

    Large buffered reads keep the number of requests to an object store low; ``read_bytes`` is the size of one.
    """
    system, inner = open_fs(path)
    codec = codec_of(path)
    if codec is None:
        return io.BufferedReader(system.open_input_file(inner), read_bytes)
    return pa.CompressedInputStream(system.open_input_stream(inner, compression=None), codec)


def read_small(path: str) -> bytes:
    """Whole content of a small side file, such as a card."""
    with open_bytes(path) as stream:
        return stream.read()


def write_small(path: str, data: bytes) -> None:
    """Write a small side file, compressed by suffix."""
    system, inner = open_fs(path)
    parent = inner.rsplit("/", 1)[0]
    if parent:
        system.create_dir(parent, recursive=True)
    with system.open_output_stream(inner, compression=codec_of(path)) as out:
        out.write(data)
