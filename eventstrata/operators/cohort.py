"""Daily metrics by creation date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventstrata.config import DEFAULT, StreamConfig
from eventstrata.functions.rates import safe_rate

DAILY_KEYS = ("date",)
DAILY_COUNTS = (
    "orders_created",
    "orders_delivered",
    "orders_cancelled",
    "orders_allocated",
    "orders_accepted",
)


def attributable(orders: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    """Orders with a creation time, under their reporting date."""
    created = F.col(config.milestone(config.creation))
    return orders.where(created.isNotNull()).withColumn("date", F.to_date(created))


def cohort_counts(config: StreamConfig = DEFAULT) -> list[Column]:
    def reached(event_type: str) -> Column:
        return F.count_if(F.col(config.milestone(event_type)).isNotNull())

    counts = (
        F.count("*"),
        F.count_if(F.col("final_status") == config.success),
        F.count_if(F.col("final_status") == config.abort),
        reached(config.allocation),
        reached(config.acceptance),
    )
    return [count.alias(name) for count, name in zip(counts, DAILY_COUNTS)]


def daily_counts(orders: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    return attributable(orders, config).groupBy("date").agg(*cohort_counts(config))


def daily_metrics(orders: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    """Counts, fulfilment and acceptance rate, mean allocation attempts per creation date.

    Acceptance may exceed 1: an order whose allocation was quarantined still counts as accepted.
    """
    counted = (
        attributable(orders, config)
        .groupBy("date")
        .agg(
            *cohort_counts(config),
            F.avg("allocation_attempts").alias("avg_allocation_attempts"),
        )
    )
    return counted.select(
        "date",
        *DAILY_COUNTS,
        safe_rate(F.col("orders_delivered"), F.col("orders_created")).alias("fulfilment_rate"),
        safe_rate(F.col("orders_accepted"), F.col("orders_allocated")).alias("acceptance_rate"),
        "avg_allocation_attempts",
    )
