"""Counts across layers, the reconciliation gate, contract checks."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventstrata.config import DEFAULT, REJECT_REASONS, StreamConfig
from eventstrata.functions.rates import safe_rate

# Report fields in published order, the required ones first.
REPORT_FIELDS = (
    "raw_events",
    "silver_events",
    "rejected_events",
    "duplicate_events_removed",
    "late_events",
    "unique_orders",
    "delivered_orders",
    "cancelled_orders",
    "open_orders",
    "exact_duplicates_removed",
    "semantic_duplicates_removed",
    "rejected_by_reason",
    "orders_missing_created_at",
    "late_event_rate",
    "reporting_days",
)


class ReconciliationError(RuntimeError):
    """The layers do not add up to the landed rows."""


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def landing_counts(validated: DataFrame) -> DataFrame:
    """One row: landed, rejected (also per reason) and valid rows."""
    reason = F.col("reject_reason")
    return validated.agg(
        F.count("*").alias("raw_events"),
        F.count(reason).alias("rejected_events"),
        F.count_if(reason.isNull()).alias("valid_events"),
        *[F.count_if(reason == code).alias(code) for code in REJECT_REASONS],
    )


def quarantine_counts(quarantine: DataFrame) -> DataFrame:
    """One row from the written quarantine: rejected rows, also per reason."""
    reason = F.col("reject_reason")
    return quarantine.agg(
        F.count("*").alias("rejected_events"),
        *[F.count_if(reason == code).alias(code) for code in REJECT_REASONS],
    )


def silver_counts(silver: DataFrame) -> DataFrame:
    """One row from Silver with copy counts.

    Losers are counted per class from the rows each survivor stands for, not as the
    difference of two layer sizes, so the reconciliation can catch a deduplication fault.
    """
    exact = _total("_valid_rows") - _total("_exact_survivors")
    semantic = _total("_exact_survivors") - F.count("*")
    late = F.count_if("is_late")
    return silver.agg(
        F.count("*").alias("silver_events"),
        exact.alias("exact_duplicates_removed"),
        semantic.alias("semantic_duplicates_removed"),
        (exact + semantic).alias("duplicate_events_removed"),
        late.alias("late_events"),
        safe_rate(late, F.count("*")).alias("late_event_rate"),
    )


def order_counts(orders: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    """One row: orders, orders per status, orders without a creation event, reporting days."""
    status = F.col("final_status")
    created = F.col(config.milestone(config.creation))
    by_day = orders.groupBy(F.to_date(created).alias("date")).agg(
        F.count("*").alias("n"),
        F.count_if(status == config.success).alias("done"),
        F.count_if(status == config.abort).alias("aborted"),
        F.count_if(status == "OPEN").alias("open"),
    )
    return by_day.agg(
        _total("n").alias("unique_orders"),
        _total("done").alias("delivered_orders"),
        _total("aborted").alias("cancelled_orders"),
        _total("open").alias("open_orders"),
        F.coalesce(F.sum(F.when(F.col("date").isNull(), F.col("n"))), F.lit(0)).alias(
            "orders_missing_created_at"
        ),
        F.count("date").alias("reporting_days"),
    )


def reject_counts(landed: Mapping[str, Any]) -> dict[str, int]:
    """Reasons that occurred, by name."""
    return {code: landed[code] for code in sorted(REJECT_REASONS) if landed[code]}


def assert_reconciles(counts: Mapping[str, Any]) -> None:
    parts = ("silver_events", "rejected_events", "duplicate_events_removed")
    total = sum(counts[p] for p in parts)
    if total != counts["raw_events"]:
        listed = " + ".join(f"{p}={counts[p]}" for p in parts)
        raise ReconciliationError(f"raw_events={counts['raw_events']} but {listed} = {total}")


def long_form(one_row: DataFrame, *columns: str) -> DataFrame:
    """A one-row table as (metric, value) rows."""
    pairs = [
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
        for c in columns or one_row.columns
    ]
    return one_row.select(F.inline(F.array(*pairs)))


def status_violations(orders: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    """One row of counts that must be zero: status domain, status against milestones, riders."""
    status = F.col("final_status")
    done = F.col(config.milestone(config.success))
    aborted = F.col(config.milestone(config.abort))
    contradiction = (
        ((status == config.success) & done.isNull())
        | ((status == config.abort) & aborted.isNull())
        | ((status == "OPEN") & (done.isNotNull() | aborted.isNotNull()))
    )
    return orders.agg(
        F.count("*").alias("orders"),
        F.count_if(~status.isin(config.success, config.abort, "OPEN")).alias("unknown_status"),
        F.count_if(contradiction).alias("contradictions"),
    )


def rider_violations(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.count("*").alias("orders"),
        F.count_if(F.col("unique_riders") > F.col("allocation_attempts")).alias("violations"),
    )


def rate_violations(daily: DataFrame) -> DataFrame:
    """Days whose rates leave [0, 1]. Reported, not enforced: acceptance may exceed 1."""

    def outside(rate: str) -> Column:
        return F.count_if(~F.col(rate).between(0, 1))

    return daily.agg(
        F.count("*").alias("days"),
        outside("fulfilment_rate").alias("fulfilment_outside"),
        outside("acceptance_rate").alias("acceptance_outside"),
    )


def grain(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("order_id").alias("distinct_keys"),
        F.count_if(F.col("order_id").isNull()).alias("null_keys"),
    )


def quarantine_gaps(quarantine: DataFrame) -> DataFrame:
    return quarantine.agg(
        F.count("*").alias("rejected_rows"),
        F.count_if(F.col("reject_reason").isNull() | F.col("_raw_payload").isNull()).alias(
            "incomplete_rows"
        ),
    )
