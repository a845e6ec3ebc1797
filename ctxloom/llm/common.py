"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ctxloom.runtime import scratch_path, ship_package, store


def read_table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The table, written once to the shared folder and read back: a cut of the lineage that outlives executors."""
    return store(df, scratch_path(df.sparkSession, label))


def wide_hash(*columns) -> tuple[Column, Column]:
    """128 bits in two longs, the same for rows with the same values in these columns; nulls are values like any other."""
    kinds = [F.col(c).isNull() for c in columns]
    return F.xxhash64(*columns, *kinds), F.xxhash64(F.lit("second"), *columns, *kinds)


def texts(batch, column: str = "text") -> list[str]:
    """The texts of an Arrow batch; null reads as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


_kept: dict = {}


def release_memory() -> None:
    """Give back what Arrow and the C library keep for later: workers stay alive when idle, beside those of the next stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def worker_state(key, make):
    """What a Python worker keeps from task to task. There is one place for it: another operator's tasks clear it."""
    if key not in _kept:
        _kept.clear()
        release_memory()
        _kept[key] = make()
    return _kept[key]


def rows_of(batch, step: int = 256):
    """(doc_id, text) of an Arrow batch, taken out a few rows at a time; null texts read as empty."""
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        yield from zip(part.column("doc_id").to_pylist(), texts(part), strict=True)


def with_doc_id(docs: DataFrame, columns: str) -> StructType:
    """Schema of a result: ``doc_id`` as in ``docs``, then the given columns."""
    rest = StructType.fromDDL(columns)
    return StructType([StructField("doc_id", docs.schema["doc_id"].dataType), *rest.fields])


def bucketed_by_block(rows: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder, bucketed by ``block``, so that joins on it shuffle only their other side."""
    spark = rows.sparkSession
    name = f"blocks_{uuid.uuid4().hex}"
    writer = rows.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block")
    writer.option("path", scratch_path(spark, "blocks")).saveAsTable(name)
    return spark.table(name)
