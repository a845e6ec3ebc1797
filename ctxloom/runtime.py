"""Session helpers: code shipping, shared scratch space and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_local_dirs: dict[str, str] = {}
_SPLIT_BYTES = 128 << 20


def build_session(app: str = "ctxloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library relies on; everything can be overridden."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="ctxloom-code-"), "ctxloom.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join("ctxloom", os.path.relpath(full, root)))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The folder every node sees, as named by ``spark.checkpoint.dir``.

    A temporary folder stands in only on a local master, where driver and executors are one process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not _is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all nodes")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="ctxloom-shared-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/ctxloom/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder, so later steps neither recompute nor fear lost executors."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def store(df: DataFrame, path: str) -> DataFrame:
    """Write a table once and go on from the written copy."""
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def spread_small(df: DataFrame) -> DataFrame:
    """Deal the rows of a small table out to all cores; leave anything larger where it lies.

    A table of less than a split per core may sit in a single row group, hence in one task, while
    encoding it is CPU work. The plan's own size estimate decides, so nothing runs to find out, and
    a large table is never shuffled here.
    """
    spark = df.sparkSession
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    cores = spark.sparkContext.defaultParallelism
    if size >= cores * _SPLIT_BYTES:
        return df
    return df.repartition(cores)


def parallelism(spark: SparkSession) -> int:
    """Partition count for rows that are tiny now but fan out in the next step.

    It is given to ``repartition`` explicitly, because adaptive coalescing judges by input bytes and
    would put all such rows in one task.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
