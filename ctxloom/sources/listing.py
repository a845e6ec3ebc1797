"""Corpus listing: which files an input names, and how large they are."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ctxloom.runtime import parallelism
from ctxloom.sources.paths import common_parent, decoded_path, is_file, literal, local_form, qualified

JSONL_SUFFIXES = (".jsonl", ".jsonl.gz", ".jsonl.zstd", ".jsonl.zst")


@dataclass(frozen=True)
class Inputs:
    """Inputs split into directories (searched by suffix) and files named one by one."""

    dirs: tuple[str, ...]
    files: tuple[str, ...]
    suffixes: tuple[str, ...]

    @property
    def glob(self) -> str:
        if len(self.suffixes) == 1:
            return "*" + self.suffixes[0]
        return "*{" + ",".join(self.suffixes) + "}"

    @property
    def parent(self) -> str:
        return common_parent(list(self.dirs), list(self.files))


def resolve_inputs(spark: SparkSession, paths: list[str] | str, ext: str | None = None) -> Inputs:
    """Sort inputs into directories and files, each kept once.

    An explicit file is taken whatever its suffix. Spark never reads names that start with ``_`` or
    ``.``: in directories they are skipped, as an explicit input they are an error.
    """
    if isinstance(paths, str):
        paths = [paths]
    if not paths:
        raise ValueError("no input paths")
    suffixes = (ext,) if ext else JSONL_SUFFIXES
    dirs: list[str] = []
    files: list[str] = []
    for path in dict.fromkeys(qualified(spark, p) for p in paths):
        if not is_file(spark, path):
            dirs.append(path)
            continue
        name = path.rsplit("/", 1)[-1]
        if name[:1] in "_.":
            raise ValueError(f"Spark does not read hidden files, rename it first: {path}")
        files.append(path)
    dirs = [d for d in dirs if not any(d != other and d.startswith(other + "/") for other in dirs)]

    def found_by_dir(path: str) -> bool:
        return path.endswith(suffixes) and any(
            path.startswith(d + "/") and not any(s[:1] in "_." for s in path[len(d) + 1 :].split("/"))
            for d in dirs
        )

    files = [f for f in files if not found_by_dir(f)]
    return Inputs(tuple(dirs), tuple(files), suffixes)


@contextmanager
def _folders_per_task(spark: SparkSession) -> Iterator[None]:
    """Readers made inside list many folders per task. Spark's own setting is a task for each, up to 10,000 of them."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    usual = spark.conf.get(key)
    spark.conf.set(key, str(min(int(usual), 4 * parallelism(spark))))
    try:
        yield
    finally:
        spark.conf.set(key, usual)


def text_scans(spark: SparkSession, inputs: Inputs) -> list[DataFrame]:
    """Line scans of the inputs: one for the files, one for the directories."""
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true")
    scans = []
    with _folders_per_task(spark):
        if inputs.files:
            scans.append(reader.text([literal(f) for f in inputs.files]))
        if inputs.dirs:
            scans.append(reader.option("pathGlobFilter", inputs.glob).text([literal(d) for d in inputs.dirs]))
    return scans


def scanned_files(scan: DataFrame) -> DataFrame:
    """(file) of every file behind a scan, empty ones included, from the index the scan already holds."""
    table = pa.table({"uri": pa.array(scan.inputFiles(), pa.string())})
    return scan.sparkSession.createDataFrame(table).select(decoded_path(F.col("uri")).alias("file")).distinct()


def _sizes(spark: SparkSession, inputs: Inputs) -> DataFrame:
    parts = []
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    with _folders_per_task(spark):
        if inputs.files:
            parts.append(reader.load([literal(f) for f in inputs.files]))
        if inputs.dirs:
            parts.append(reader.option("pathGlobFilter", inputs.glob).load([literal(d) for d in inputs.dirs]))
    out = None
    for part in parts:
        part = part.select(local_form(F.col("path")).alias("file"), F.col("length").alias("bytes"))
        out = part if out is None else out.unionByName(part)
    return out


def list_corpus(spark: SparkSession, paths: list[str] | str, ext: str | None = None) -> DataFrame:
    """(file, bytes) of every input file.

    Sizes come from a ``binaryFile`` scan that never opens a file. That scan leaves out files of zero
    bytes, so names come from the file index, which Spark holds on the driver for any scan.
    """
    inputs = resolve_inputs(spark, paths, ext)
    scans = text_scans(spark, inputs)
    names = scanned_files(scans[0])
    for scan in scans[1:]:
        names = names.unionByName(scanned_files(scan))
    return names.join(_sizes(spark, inputs), "file", "left").select(
        "file", F.coalesce("bytes", F.lit(0)).cast("bigint").alias("bytes")
    )


def list_sized(spark: SparkSession, paths: list[str] | str, ext: str | None = None) -> DataFrame:
    """(file, bytes) of the non-empty input files, straight from the scan and split by size into tasks."""
    return _sizes(spark, resolve_inputs(spark, paths, ext))


def dataset_size(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes under a folder, at any depth, as one row."""
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(literal(folder))
    return scan.agg(F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("size"))
