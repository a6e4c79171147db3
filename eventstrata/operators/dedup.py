"""Two-stage duplicate removal that counts what it removes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventstrata.config import DEFAULT, StreamConfig
from eventstrata.functions.times import seconds_between


def silver_columns(config: StreamConfig = DEFAULT) -> tuple[str, ...]:
    """The fields, the event date behind the arrival, lateness and lineage."""
    at = config.fields.index("ingested_at") + 1
    head, tail = config.fields[:at], config.fields[at:]
    return (*head, "event_date", *tail, "lateness_seconds", "is_late", "_source_row", "_source_file")


SILVER_COLUMNS = silver_columns()
SILVER_KEYS = ("order_id", "event_time", "event_id")
COPY_COUNTS = ("_valid_rows", "_exact_survivors")


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    copies: str,
    totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """The smallest row per key in ``order``, with the number of rows it stands for.

    An aggregate rather than a ranking window: it combines on the map side, so a key that
    holds a third of all rows leaves each task as one row, and the copies are counted in
    the same shuffle. NULL keys group together. Columns behind ``order`` break ties, which
    makes the result independent of arrival order. ``totals`` maps output to summed input.
    """
    totals = dict(totals or {})
    skip = {*keys, *order, *totals.values()}
    ranked = F.struct(*order, *[c for c in df.columns if c not in skip])
    best = df.groupBy(*keys).agg(
        F.min(ranked).alias("_best"),
        F.count("*").alias(copies),
        *[F.sum(source).alias(name) for name, source in totals.items()],
    )
    return best.select(*keys, "_best.*", copies, *totals)


def dedup_input(validated: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    """The columns of valid rows that outlive deduplication; of the payload, its digest."""
    return validated.select(*config.fields, "_payload_md5", "_source_file", "_source_row")


def drop_exact(typed: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    """Redelivered ids: the earliest arrival stays, then the smallest payload digest."""
    order = ("ingested_at", "_payload_md5", "_source_file", "_source_row")
    return keep_first(typed, config.exact_key, order, "_copies").drop("_payload_md5")


def drop_semantic(exact: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    """One fact sent under several ids: the earliest arrival stays, then the smallest id.

    Grouping by the whole business key spreads a hot order over all tasks.
    """
    return keep_first(
        exact,
        config.semantic_key,
        ("ingested_at", "event_id"),
        "_exact_survivors",
        {"_valid_rows": "_copies"},
    )


def to_silver(survivors: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    """Published columns plus the copy counts that the reconciliation adds up."""
    lateness = seconds_between(F.col("event_time"), F.col("ingested_at"))
    timed = survivors.withColumn("event_date", F.to_date("event_time")).withColumn(
        "lateness_seconds", lateness
    )
    late = F.col("lateness_seconds") > config.lateness_threshold_seconds
    return timed.withColumn("is_late", late).select(*silver_columns(config), *COPY_COUNTS)


def silver_with_counts(typed: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    return to_silver(drop_semantic(drop_exact(typed, config), config), config)
