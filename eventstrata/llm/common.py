"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a text column, None where it is null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type)
    return column.cast(pa.large_binary() if wide else pa.binary()).to_pylist()


def whole_groups(batches: Iterable[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Regroup sorted batches so that no run of equal keys spans two tables.

    At most one group is carried over, so memory is one batch and the largest group.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        cut = _last_change(batch, keys)
        if cut == 0 and len(held) > 1 and _same_key(held[0], -1, batch, 0, keys):
            continue
        if cut == 0 and len(held) == 1:
            continue
        done = pa.Table.from_batches([*held[:-1], batch.slice(0, cut)])
        held = [batch.slice(cut)]
        yield done
    if held:
        yield pa.Table.from_batches(held)


def _same_key(a: pa.RecordBatch, i: int, b: pa.RecordBatch, j: int, keys: Sequence[str]) -> bool:
    i = i % a.num_rows
    return all(a.column(k)[i].as_py() == b.column(k)[j].as_py() for k in keys)


def _last_change(batch: pa.RecordBatch, keys: Sequence[str]) -> int:
    """Index of the first row of the last group in the batch."""
    return int(group_starts(batch, keys)[-1])


def group_starts(rows: pa.RecordBatch | pa.Table, keys: Sequence[str]) -> np.ndarray:
    """Where each run of equal keys begins. Nulls equal each other."""
    n = rows.num_rows
    changed = np.zeros(n, dtype=bool)
    if n:
        changed[0] = True
    for key in keys:
        column = rows.column(key)
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if n < 2:
            continue
        a, b = column.slice(0, n - 1), column.slice(1)
        differ = pc.fill_null(pc.not_equal(a, b), False)
        one_null = pc.xor(pc.is_null(a), pc.is_null(b))
        changed[1:] |= np.asarray(pc.or_(differ, one_null))
    return np.flatnonzero(changed)


def numbers(rows: pa.RecordBatch | pa.Table, name: str) -> np.ndarray:
    column = rows.column(name)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.to_numpy(zero_copy_only=False)


def held_out(doc_id="doc_id"):
    """Every fourth document by checksum of its id: never learned from."""
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2


def least_hashed(
    rows: DataFrame, by: str, order: Sequence[str], limit: int, expected: int, *columns: str | Column
) -> list[Row]:
    """``columns`` of the ``limit`` rows of least ``by``, a 64-bit hash, ties in ``order``.

    Only rows below a hash that about 1.2 times ``limit`` of ``expected`` rows undercut are
    ordered, so what tasks send to the driver does not grow with their number. Where that
    finds too few (``expected`` counted repeats, or rows that a join drops) the bound is
    raised, in the end to none, so the rows are the same whatever is expected.
    """
    share = (1.2 * limit + 100) / max(expected, 1)
    while True:
        some = rows if share >= 1 else rows.where(F.col(by) < F.lit(int(share * 2**64) - 2**63))
        found = some.orderBy(by, *order).limit(limit).select(*columns).collect()
        if share >= 1 or len(found) >= limit:
            return found
        share *= 8
