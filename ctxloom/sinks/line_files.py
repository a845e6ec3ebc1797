"""Many small gzipped text files, several lines each."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctxloom.runtime import ship_package
from ctxloom.sources.paths import open_fs, qualified

_LEVEL = 1  # files are read once or twice: on repetitive texts level 6 takes five times as long


def write_line_files(rows: DataFrame, folder: str, file_name: str) -> int:
    """Write (name, line) as ``<folder>/<name>/<file_name>``, gzipped; returns the number of files.

    Lines of one name must be together in one task and in order. A file shows up whole, and a task that
    is run twice writes the same files again, so the driver has nothing to move at the end.
    """
    ship_package(rows.sparkSession)
    folder = qualified(rows.sparkSession, folder)
    system, inner = open_fs(folder)
    system.create_dir(inner, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, inner = open_fs(folder)
        lines = (row for b in batches for row in zip(b.column("name").to_pylist(), b.column("line").to_pylist()))
        files = 0
        for name, group in groupby(lines, key=lambda row: row[0]):
            system.create_dir(f"{inner}/{name}", recursive=True)
            temp = f"{inner}/{name}/.{uuid.uuid4().hex}"
            packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
            with system.open_output_stream(temp, compression=None) as out:
                for _, line in group:
                    out.write(packer.compress(line.encode() + b"\n"))
                out.write(packer.flush())
            system.move(temp, f"{inner}/{name}/{file_name}")
            files += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64())})

    written = rows.select("name", "line").mapInArrow(run, "files bigint")
    return written.agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]
