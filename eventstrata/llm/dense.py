"""Sums of dense vectors over many tasks, level by level."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventstrata.llm.common import group_starts, whole_groups

FAN = 32


def part_number() -> int:
    """The number of the running task's partition, which ``tree_sum`` groups by."""
    return TaskContext.get().partitionId()


def matrix(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of equally long lists without nulls as rows of a matrix."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    values = lists.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(lists), -1) if len(lists) else values.reshape(0, 0)


def rows_of(block: np.ndarray, part: int, values: np.ndarray) -> pa.RecordBatch:
    """Partial sums as rows (block, part, values): one row of ``values`` per block."""
    kind = pa.int64() if values.dtype.kind == "i" else pa.float64()
    offsets = np.arange(len(block) + 1, dtype=np.int32) * values.shape[1]
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), kind))
    parts = pa.array(np.full(len(block), part, dtype=np.int64))
    return pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), parts, lists], names=["block", "part", "values"])


def schema(kind: str) -> str:
    return f"block long, part long, values array<{kind}>"


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in whole_groups(batches, ["block", "to"]):
        starts = group_starts(group, ["block", "to"])
        ends = np.r_[starts[1:], group.num_rows]
        block, to = (group.column(c).to_numpy() for c in ("block", "to"))
        for lo, hi in zip(starts, ends):
            total = matrix(group.column("values").slice(lo, hi - lo)).sum(axis=0, keepdims=True)
            yield rows_of(block[lo : lo + 1], int(to[lo]), total)


def tree_sum(parts: DataFrame, kind: str, fan: int = FAN) -> DataFrame:
    """One row per block with the sum of its vectors; columns block, values.

    ``parts`` are partial sums (block, part, values), at most one per block and task, part
    being the task's number; vectors of one block are equally long. Each level adds at most
    ``fan`` vectors of a block in one group, so no task gathers a block's rows of all tasks.
    The order of additions is fixed by the part numbers.
    """
    width = max(parts.rdd.getNumPartitions(), 1)
    while True:
        width = -(-width // fan)
        dealt = parts.withColumn("to", F.floor(F.col("part") / fan).cast("long")).repartition("block", "to")
        parts = dealt.sortWithinPartitions("block", "to", "part").mapInArrow(_add, schema(kind))
        if width <= 1:
            return parts.select("block", "values")
