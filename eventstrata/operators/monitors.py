"""Data monitors over the layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventstrata.functions.rates import safe_rate
from eventstrata.functions.times import seconds_between


def lateness_percentiles(silver: DataFrame, shares: Sequence[float]) -> DataFrame:
    """Lateness distribution per event type, to choose the threshold from.

    Exact and discrete at every size: events are first counted per whole second, and the
    running totals of that histogram give the percentiles. A type's histogram is bounded by
    the seconds that occur, not by its events. Shares count to a thousandth.
    """
    histogram = silver.groupBy("event_type", "lateness_seconds").agg(F.count("*").alias("_n"))
    up_to = W.partitionBy("event_type").orderBy("lateness_seconds")
    reached = histogram.select(
        "event_type",
        "lateness_seconds",
        "_n",
        F.sum("_n").over(up_to).alias("_up_to"),
        F.sum("_n").over(W.partitionBy("event_type")).alias("_all"),
    )

    def percentile(share: float) -> Column:
        enough = F.col("_up_to") * 1000 >= F.col("_all") * round(share * 1000)
        return F.min(F.when(enough, F.col("lateness_seconds"))).alias(f"p{round(share * 100)}")

    return reached.groupBy("event_type").agg(
        F.sum("_n").alias("events"), *[percentile(s) for s in shares]
    )


def daily_quality(silver: DataFrame) -> DataFrame:
    """Duplicate rate per class, late rate and freshness per event date."""
    exact = F.sum("_valid_rows") - F.sum("_exact_survivors")
    semantic = F.sum("_exact_survivors") - F.count("*")
    late = F.count_if("is_late")
    valid = F.sum("_valid_rows")
    return silver.groupBy("event_date").agg(
        F.count("*").alias("silver_events"),
        exact.alias("exact_removed"),
        semantic.alias("semantic_removed"),
        safe_rate(exact, valid).alias("exact_rate"),
        safe_rate(semantic, valid).alias("semantic_rate"),
        safe_rate(late, F.count("*")).alias("late_rate"),
        F.max("ingested_at").alias("newest_arrival"),
        F.max(seconds_between(F.col("event_time"), F.col("ingested_at"))).alias("worst_lag"),
    )


def reject_rates(validated: DataFrame) -> DataFrame:
    """Rejected rows and their share of all rows, per event date and reason.

    The date is the event's, else that of its arrival; rows with neither count under NULL.
    """
    date = F.to_date(F.coalesce("event_time", "ingested_at")).alias("event_date")
    counted = validated.groupBy(date, "reject_reason").agg(F.count("*").alias("rejected_rows"))
    all_rows = F.sum("rejected_rows").over(W.partitionBy("event_date")).alias("rows")
    rates = counted.select("event_date", "reject_reason", "rejected_rows", all_rows)
    rate = safe_rate(F.col("rejected_rows"), F.col("rows")).alias("reject_rate")
    return rates.where("reject_reason is not null").select("*", rate)


def attempts_drift(orders: DataFrame) -> DataFrame:
    """Distribution of allocation attempts, for drift alarms."""
    return orders.groupBy("allocation_attempts").agg(F.count("*").alias("orders"))


def duplicate_estimate(typed: DataFrame, error: float = 0.02) -> DataFrame:
    """Share of repeated ids from a sketch: a cheap check before the exact stage."""
    rows = F.count("*")
    ids = F.approx_count_distinct("event_id", error)
    return typed.agg(
        rows.alias("valid_events"),
        ids.alias("estimated_ids"),
        safe_rate(F.greatest(rows - ids, F.lit(0)), rows).alias("estimated_duplicate_rate"),
    )


def stuck_orders(silver: DataFrame, orders: DataFrame, idle_hours: int) -> DataFrame:
    """Open orders whose last event is older than the bound, against the newest event seen.

    No clock: the newest event time is a scalar subquery on Silver. An event counts no later
    than it arrived, so one with a future time does not make every open order stuck.
    """
    newest = silver.agg(F.max(F.least("event_time", "ingested_at"))).scalar()
    last = silver.groupBy("order_id").agg(F.max("event_time").alias("last_event_at"))
    idle = last.where(
        F.col("last_event_at") < newest - F.make_dt_interval(hours=F.lit(idle_hours))
    )
    is_open = orders.where(F.col("final_status") == "OPEN")
    return is_open.join(idle, "order_id").select(
        "order_id", "created_at", "last_event_at", "allocation_attempts", "event_count"
    )


def layer_violations(silver: DataFrame, orders: DataFrame, daily: DataFrame) -> DataFrame:
    """One row of counts that must be zero between Silver, orders and daily metrics."""
    ids = silver.groupBy("order_id").agg(F.count("*").alias("_events"))
    pairs = ids.join(orders.select("order_id", "event_count"), "order_id", "full_outer")
    layers = pairs.agg(
        F.count_if(F.col("event_count").isNull()).alias("silver_without_order"),
        F.count_if(F.col("_events").isNull()).alias("order_without_silver"),
        F.count_if(F.col("_events") != F.col("event_count")).alias("event_count_mismatch"),
    )
    counters = orders.agg(
        F.count_if((F.col("allocation_attempts") < 0) | (F.col("event_count") < 1)).alias("n"),
        F.count_if(F.col("created_at").isNotNull()).alias("attributable"),
    )
    created = daily.agg(F.coalesce(F.sum("orders_created"), F.lit(0)).alias("created"))
    return layers.select(
        "*",
        counters.select("n").scalar().alias("bad_counters"),
        (counters.select("attributable").scalar() - created.scalar()).alias("unreported_orders"),
    )
