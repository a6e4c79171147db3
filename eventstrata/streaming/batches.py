"""A table that micro-batches append to, with small files merged in tiers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventstrata.session import reread
from eventstrata.sinks.generations import Generations


def batch_folder(path: str, batch_id: int) -> str:
    """A retried micro-batch overwrites its own folder, so nothing is written twice."""
    return f"{path}/batch_id={batch_id}"


class BatchTable:
    """Rows of micro-batches in date folders; batch ids follow each other from 0.

    Each batch writes ``batch_id=<n>/event_date=<d>``. With ``compact_every`` the folders of
    so many finished batches become one run, and so many runs of a size one larger run, so a
    date has at most ``compact_every`` files' worth of folders per tier and what a batch lists
    grows with the logarithm of its number. Rows are rewritten once per tier. The runs in
    force are a generation (``Generations``) beside the table, ``<path>-runs``: its names say
    which batches they hold, the highest is the watermark up to which batch folders are
    superseded, and readers move from the folders to the run at once. Superseded folders are
    removed one compaction later, so that open readers finish.

    A batch starts only after the one before it is committed, so compacting what lies before
    a batch never merges rows that a retry would write again.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, compact_every: int | None = None):
        if compact_every is not None and compact_every < 2:
            raise ValueError(f"compact at least two batches at a time, got {compact_every}")
        self.spark, self.path, self.schema, self.every = spark, path, schema, compact_every
        self.store = Generations(spark, f"{path}-runs")

    def write(self, rows: DataFrame, batch_id: int) -> DataFrame:
        return self._write(rows, batch_folder(self.path, batch_id))

    def _write(self, rows: DataFrame, path: str) -> DataFrame:
        """Date folders; adaptive rebalancing joins small dates and splits a big one."""
        dealt = rows.hint("rebalance", "event_date")
        dealt.write.mode("overwrite").option("compression", "zstd").partitionBy("event_date").parquet(path)
        return reread(rows, path)

    def runs(self) -> list[tuple[int, int, str]]:
        """(first batch, last batch, path) of the runs in force, in order."""
        found = [(*map(int, name.split("-")), path) for name, path in self.store.layers().items()]
        return sorted(found)

    def before(self, batch_id: int) -> DataFrame:
        """What the batches before this one wrote, also when this one is a retry."""
        if self.every is None:
            return self._all_folders(batch_id)
        runs = [r for r in self.runs() if r[1] < batch_id]
        first = runs[-1][1] + 1 if runs else 0
        return self._read([r[2] for r in runs], range(first, batch_id))

    def _reader(self) -> DataFrameReader:
        schema = T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())])
        return self.spark.read.schema(schema).option("basePath", self.path)

    def _all_folders(self, batch_id: int) -> DataFrame:
        if batch_id == 0:
            return self.spark.createDataFrame([], self.schema)
        return self._reader().parquet(self.path).where(F.col("batch_id") < batch_id).drop("batch_id")

    def _read(self, runs: Sequence[str], batches: Sequence[int]) -> DataFrame:
        """Some runs, each a table of its own, and some batches' folders."""
        parts = [self.spark.read.schema(self.schema).parquet(path) for path in runs]
        if batches:
            folders = [batch_folder(self.path, n) for n in batches]
            parts.append(self._reader().parquet(*folders).drop("batch_id"))
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], self.schema)

    def compact(self, batch_id: int) -> bool:
        """Merge the batches before ``batch_id`` if enough of them lie in folders of their own."""
        if self.every is None:
            return False
        runs = self.runs()
        last = runs[-1][1] if runs else -1
        if batch_id - 1 - last < self.every:
            return False
        fresh, first = range(last + 1, batch_id), last + 1
        paths: list[str] = []
        merged: list[str] = []
        while True:
            size = batch_id - first
            alike = [r for r in runs if r[1] - r[0] < size]
            if len(alike) < self.every - 1:
                break
            runs = runs[: len(runs) - len(alike)]
            first = alike[0][0]
            paths = [r[2] for r in alike] + paths
            merged += [f"{r[0]}-{r[1]}" for r in alike]
        folder = self.store.begin()
        self._write(self._read(paths, fresh), f"{folder}/rows")
        self.store.publish(folder, {f"{first}-{batch_id - 1}": "rows"}, merged)
        self.store.vacuum(keep=2)
        self._remove_folders(last)
        return True

    def _remove_folders(self, last: int) -> None:
        """Folders of batches that a run has held since the compaction before."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        fs = hadoop.Path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        n = last
        while n >= 0 and fs.delete(hadoop.Path(batch_folder(self.path, n)), True):
            n -= 1
