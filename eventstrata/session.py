"""Session settings the expressions rely on, and the folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from functools import cache
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def configure(spark: SparkSession) -> SparkSession:
    """Pin the session to UTC: zone-less input and date derivation depend on it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="eventstrata-")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only on a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_folder()


_workspace: ContextVar[str | None] = ContextVar("workspace", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    folder = _workspace.get() or f"{scratch_root(spark)}/eventstrata"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


@contextmanager
def workspace(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder for everything staged inside the block; removed at its end, also on failure.

    Nothing that reads staged tables may outlive the block.
    """
    folder = scratch_path(spark, name)
    token = _workspace.set(folder)
    try:
        yield folder
    finally:
        _workspace.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows of a source with fewer splits than the cluster has cores, dealt out by key.

    For a small source in front of costly row work. A source with splits enough stays as it
    is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def reread(df: DataFrame, path: str) -> DataFrame:
    """The table as written under ``path``, also when it holds no row."""
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write a table once and continue from the files.

    Everything downstream then reads only the columns it needs, and a lost executor
    costs the re-read of a split instead of the whole lineage.
    """
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return reread(df, path)


def stage_counted(df: DataFrame, path: str) -> tuple[DataFrame, int]:
    """Stage a table and learn its row count from the same write."""
    written = Observation()
    staged = stage(df.observe(written, F.count("*").alias("rows")), path)
    return staged, written.get["rows"]


def in_parallel(spark: SparkSession, *tasks: Callable[[], Any]) -> list[Any]:
    """Run independent Spark actions at the same time, so that one fills the other's tail."""
    with ThreadPoolExecutor(len(tasks)) as pool:
        running = [
            pool.submit(copy_context().run, inheritable_thread_target(spark)(task)) for task in tasks
        ]
        return [job.result() for job in running]
