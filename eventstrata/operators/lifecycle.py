"""One lifecycle row per order, from event time alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventstrata.config import DEFAULT, StreamConfig
from eventstrata.sources.vocabulary import vocabulary

ORDER_KEYS = ("order_id",)


def order_columns(config: StreamConfig = DEFAULT) -> tuple[str, ...]:
    return (
        "order_id",
        *[t.milestone for t in config.event_types],
        "final_status",
        "allocation_attempts",
        "unique_riders",
        "city",
        "supplier_id",
        "event_count",
    )


def with_rank(silver: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    known = vocabulary(silver.sparkSession, config).drop("is_terminal")
    return silver.join(F.broadcast(known), "event_type")


def milestones(config: StreamConfig = DEFAULT) -> list[Column]:
    """First time each type was seen, NULL when never."""
    return [
        F.min(F.when(F.col("event_type") == t.name, F.col("event_time"))).alias(t.milestone)
        for t in config.event_types
    ]


def attempts(config: StreamConfig = DEFAULT) -> Column:
    return F.count_if(F.col("event_type") == config.allocation)


def _placed(value: str, only: Column | None = None) -> Column:
    """A non-NULL value behind its total event order: time, lifecycle rank, event id."""
    present = F.col(value).isNotNull()
    return F.when(
        present if only is None else present & only,
        F.struct("event_time", "lifecycle_rank", "event_id", value),
    )


def first_city(config: StreamConfig = DEFAULT) -> Column:
    """Earliest city on the creation event, else the earliest on any event."""
    created = F.min(_placed("city", F.col("event_type") == config.creation))
    return F.coalesce(created["city"], F.min(_placed("city"))["city"])


def last_supplier() -> Column:
    return F.max(_placed("supplier_id"))["supplier_id"]


def riders_per_order(silver: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    """Distinct allocated riders. Two aggregations, so no task ever holds an order's riders."""
    allocated = (F.col("event_type") == config.allocation) & F.col("rider_id").isNotNull()
    pairs = silver.where(allocated).select("order_id", "rider_id").distinct()
    return pairs.groupBy("order_id").agg(F.count("*").alias("unique_riders"))


def final_status(config: StreamConfig = DEFAULT) -> Column:
    """First success against first abort; a tie counts as success."""
    done = F.col(config.milestone(config.success))
    aborted = F.col(config.milestone(config.abort))
    return (
        F.when(done.isNull() & aborted.isNull(), "OPEN")
        .when(aborted.isNull() | (done >= aborted), config.success)
        .otherwise(config.abort)
    )


def reconstruct(silver: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    """Order rows from a stored Silver table.

    Silver is read twice: in full width for one decomposable aggregate per order, and for
    allocations only as (order, rider) pairs. Both sides end up partitioned by order, so
    the join adds no exchange; map-side combining covers an order with a third of all rows.
    """
    per_order = (
        with_rank(silver, config)
        .groupBy("order_id")
        .agg(
            *milestones(config),
            attempts(config).alias("allocation_attempts"),
            first_city(config).alias("city"),
            last_supplier().alias("supplier_id"),
            F.count("*").alias("event_count"),
        )
    )
    return (
        per_order.join(riders_per_order(silver, config), "order_id", "left")
        .withColumn("unique_riders", F.coalesce("unique_riders", F.lit(0)))
        .withColumn("final_status", final_status(config))
        .select(*order_columns(config))
    )
