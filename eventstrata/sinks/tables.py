"""Table writers: total order, date partitions, targeted restatement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventstrata.session import scratch_path, stage, workspace


def write_ordered(
    df: DataFrame, path: str, keys: Sequence[str], compression: str = "zstd"
) -> None:
    """Replace a table by ``df`` in total key order: part files follow the key ranges.

    Ranges come from a sample of unique keys, so they split a hot order like any other.
    """
    (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .write.mode("overwrite")
        .option("compression", compression)
        .parquet(path)
    )


def write_small_ordered(
    df: DataFrame, path: str, keys: Sequence[str], compression: str = "zstd"
) -> None:
    """As one sorted file: for tables whose grain bounds them, like one row per day."""
    (
        df.repartition(1)
        .sortWithinPartitions(*keys)
        .write.mode("overwrite")
        .option("compression", compression)
        .parquet(path)
    )


def write_scan_order(df: DataFrame, path: str, compression: str = "zstd") -> None:
    """Replace a table by ``df`` as it comes, without a shuffle."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def write_by_date(
    df: DataFrame, path: str, date: str, keys: Sequence[str], compression: str = "zstd"
) -> None:
    """Partition folders per date, sorted by key inside; a big date spans several files.

    Only the dates present in ``df`` are replaced.
    """
    (
        df.repartitionByRange(date, *keys)
        .sortWithinPartitions(date, *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(date)
        .parquet(path)
    )


def restate_dates(
    df: DataFrame, path: str, date: str, keys: Sequence[str], compression: str = "zstd"
) -> None:
    """Replace whole dates of a date-partitioned table by rows that may derive from it.

    The rows are staged first: their source must not change while they are computed.
    """
    spark = df.sparkSession
    with workspace(spark, "restate"):
        write_by_date(stage(df, scratch_path(spark, "rows")), path, date, keys, compression)


def write_report(report: DataFrame, path: str) -> None:
    """The single report row as one JSON file, absent values spelled out."""
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def rows_of_dates(stored: DataFrame, new: DataFrame, date: str = "event_date") -> DataFrame:
    """Stored rows of every date that ``new`` touches. The calendar bounds the broadcast."""
    dates = new.select(F.col(date)).distinct()
    return stored.join(F.broadcast(dates), date, "left_semi")
