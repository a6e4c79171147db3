"""How a stored table lies in its files: positions of rows, and whether they follow an order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _placed(stored: DataFrame) -> DataFrame:
    return stored.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at")
    )


def with_position(stored: DataFrame, name: str = "position") -> DataFrame:
    """A table read from files with each row's place, from 0, over its files by name."""
    rows = _placed(stored)
    before = W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1)
    # One row per file, so one task may add them up.
    files = rows.groupBy("_file").agg(F.count("*").alias("_rows"))
    files = files.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return rows.join(files, "_file").select(*stored.columns, (F.col("_before") + F.col("_at")).alias(name))


def physical_order(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, unordered_rows and unordered_parts of a table read from files.

    A row is unordered if the row before it in its file has a greater key, a part if the
    last key of the part before it (by name) is greater than its first. Both are zero
    exactly if reading the files one after the other yields the rows in key order; equal
    keys may follow each other. NULL sorts first.
    """
    rows = _placed(stored).select("_file", "_at", F.struct(*keys).alias("_key"))
    in_file = W.partitionBy("_file").orderBy("_at")
    steps = rows.withColumn("_last", F.lag("_key").over(in_file))
    parts = steps.groupBy("_file").agg(
        F.count("*").alias("_rows"),
        F.count_if(F.col("_last") > F.col("_key")).alias("_wrong"),
        F.min_by("_key", "_at").alias("_from"),
        F.max_by("_key", "_at").alias("_to"),
    )
    steps = parts.withColumn("_last", F.lag("_to").over(W.orderBy("_file")))
    return steps.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("_wrong"), F.lit(0)).alias("unordered_rows"),
        F.count_if(F.col("_last") > F.col("_from")).alias("unordered_parts"),
    )
