"""Update stored layers from what a batch touched instead of rebuilding them."""

from __future__ import annotations

import datetime as dt
from bisect import bisect_right
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventstrata.config import DEFAULT, EventType, StreamConfig
from eventstrata.operators.cohort import attributable, daily_metrics
from eventstrata.operators.dedup import drop_exact
from eventstrata.operators.lifecycle import reconstruct
from eventstrata.operators.validate import validate
from eventstrata.session import scratch_path, stage_counted
from eventstrata.sources.lines import land_rows

SALTS = 64


def id_ranges(index: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    """Per date of an id index the least and the greatest key and their number: a row per day."""
    key = F.struct(*config.exact_key)
    return index.groupBy("event_date").agg(
        F.min(key).alias("lowest"), F.max(key).alias("highest"), F.count("*").alias("ids")
    )


def dates_to_search(
    batch: DataFrame, ranges: DataFrame, since: dt.date, config: StreamConfig = DEFAULT
) -> list[dt.date]:
    """Index dates on or after ``since`` that can hold a key of the batch, in order.

    The batch's keys are ranged per event date. A date whose own range meets none of them
    holds none of the keys. Producers that count their ids up, or put the time in front,
    leave a batch with the few dates it is about; with random ids every date stays. Both
    sides have a row per day, so they are compared on the driver.
    """
    asked = id_ranges(batch.withColumn("event_date", F.to_date("event_time")), config).collect()
    spans: list[list[tuple]] = []
    for low, high in sorted((tuple(r["lowest"]), tuple(r["highest"])) for r in asked):
        if spans and low <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], high)
        else:
            spans.append([low, high])
    lows = [low for low, _ in spans]

    def meets(low: tuple, high: tuple) -> bool:
        at = bisect_right(lows, high) - 1
        return at >= 0 and spans[at][1] >= low

    stored = ranges.where(F.col("event_date") >= F.lit(since)).collect()
    return sorted(r["event_date"] for r in stored if meets(tuple(r["lowest"]), tuple(r["highest"])))


def unseen_events(
    batch: DataFrame,
    index: DataFrame,
    since: dt.date,
    config: StreamConfig = DEFAULT,
    ranges: DataFrame | None = None,
) -> DataFrame:
    """Valid rows of a batch, one per id, whose id the recent index does not hold.

    The batch is combined per id before the join, so copies of one id never meet in it; the
    index is cut to the partitions on or after ``since``. With the stored ``id_ranges`` of
    the index only those dates are read whose ids can be in the batch.
    """
    recent = index.where(F.col("event_date") >= F.lit(since))
    if ranges is not None:
        recent = recent.where(F.col("event_date").isin(dates_to_search(batch, ranges, since, config)))
    recent = recent.select(*config.exact_key)
    return drop_exact(batch, config).join(recent, list(config.exact_key), "left_anti")


def events_of(
    silver: DataFrame, ids: DataFrame, ids_count: int, config: StreamConfig = DEFAULT
) -> DataFrame:
    """Silver rows of the given distinct orders, without gathering an order in one task.

    Few ids are broadcast. Many are repeated once per salt and joined on order and salt: a
    plain join would leave Silver partitioned by order, and the aggregation behind it would
    take a hot order from a single task instead of combining it map-side first.
    """
    if ids_count <= config.max_broadcast_ids:
        return silver.join(F.broadcast(ids), "order_id", "left_semi")
    salted = ids.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = silver.withColumn("_salt", F.pmod(F.xxhash64("event_id"), F.lit(SALTS)).cast("int"))
    return spread.join(salted, ["order_id", "_salt"], "left_semi").drop("_salt")


def refresh_orders(
    orders: DataFrame, silver: DataFrame, touched: DataFrame, config: StreamConfig = DEFAULT
) -> DataFrame:
    """Rebuild the touched orders from Silver, keep all others as they are.

    Touch wins over any freeze: an event after the grace period reopens its order.
    """
    spark = silver.sparkSession
    ids, count = stage_counted(
        touched.select("order_id").distinct(), scratch_path(spark, "touched-orders")
    )
    rebuilt = reconstruct(events_of(silver, ids, count, config), config)
    return orders.join(ids, "order_id", "left_anti").unionByName(rebuilt)


def refresh_daily(
    daily: DataFrame,
    orders_before: DataFrame,
    orders_now: DataFrame,
    touched: DataFrame,
    config: StreamConfig = DEFAULT,
) -> DataFrame:
    """Recompute the creation dates that touched orders had before or have now."""
    ids = touched.select("order_id").distinct()
    changed = orders_before.unionByName(orders_now).join(ids, "order_id", "left_semi")
    # The calendar bounds this table, so it may be broadcast: hot dates are not shuffled.
    dates = F.broadcast(attributable(changed, config).select("date").distinct())
    affected = attributable(orders_now, config).join(dates, "date", "left_semi").drop("date")
    return daily.join(dates, "date", "left_anti").unionByName(daily_metrics(affected, config))


def replay(quarantine: DataFrame, config: StreamConfig) -> DataFrame:
    """Judge quarantined payloads again under a changed config."""
    return validate(land_rows(quarantine, config), config)


def with_event_type(config: StreamConfig, event_type: EventType) -> StreamConfig:
    return replace(config, event_types=(*config.event_types, event_type))
