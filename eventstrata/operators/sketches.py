"""Mergeable sketches per date: distinct ids and lateness, stored once and united at will."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventstrata.functions.times import seconds_between


@dataclass(frozen=True)
class SketchSize:
    """Sizes, and the errors that the estimates stay within (three standard errors and more)."""

    log_buckets: int = 14  # of the distinct sketch: 1.04 / sqrt(2 ** 14) is 0.8 %
    distinct_error: float = 0.03  # relative
    quantile_k: int = 400  # of the quantile sketch: about 0.7 % of rank
    rank_error: float = 0.02


DEFAULT_SIZE = SketchSize()


def daily_sketches(typed: DataFrame, size: SketchSize = DEFAULT_SIZE) -> DataFrame:
    """event_date, event_type, rows, ids (HLL) and lateness (KLL) of valid rows.

    A few kilobytes per date and type whatever the number of rows, built before the shuffle.
    """
    lateness = seconds_between(F.col("event_time"), F.col("ingested_at"))
    return typed.groupBy(F.to_date("event_time").alias("event_date"), "event_type").agg(
        F.count("*").alias("rows"),
        F.hll_sketch_agg("event_id", F.lit(size.log_buckets)).alias("ids"),
        F.kll_sketch_agg_bigint(lateness, F.lit(size.quantile_k)).alias("lateness"),
    )


def distinct_ids(sketches: DataFrame, *keys: str) -> DataFrame:
    """Rows and estimated distinct ids per ``keys``, from united sketches alone."""
    return sketches.groupBy(*keys).agg(
        F.sum("rows").alias("rows"),
        F.hll_sketch_estimate(F.hll_union_agg("ids")).alias("estimated_ids"),
    )


def distinct_error(sketches: DataFrame, typed: DataFrame, *keys: str) -> DataFrame:
    """Estimates next to exact counts per ``keys``: estimated_ids, ids, relative_error."""
    dated = typed.withColumn("event_date", F.to_date("event_time"))
    exact = dated.groupBy(*keys).agg(F.count_distinct("event_id").alias("ids"))
    both = distinct_ids(sketches, *keys)
    # Without keys both sides are one row.
    both = both.join(exact, list(keys)) if keys else both.withColumn("ids", exact.scalar())
    error = F.abs(F.col("estimated_ids") - F.col("ids")) / F.col("ids")
    return both.withColumn("relative_error", error)


def lateness_quantiles(sketches: DataFrame, shares: Sequence[float], *keys: str) -> DataFrame:
    """Lateness at each share per ``keys``, from merged sketches: keys, rows, share, lateness_seconds."""
    merged = sketches.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.kll_merge_agg_bigint("lateness").alias("_merged")
    )
    points = [
        F.struct(
            F.lit(s).alias("share"),
            F.kll_sketch_get_quantile_bigint("_merged", F.lit(s)).alias("lateness_seconds"),
        )
        for s in shares
    ]
    return merged.select(*keys, "rows", F.inline(F.array(*points)))


def rank_errors(quantiles: DataFrame, typed: DataFrame, *keys: str) -> DataFrame:
    """Adds rank_error: how far a share lies outside the exact ranks of its value.

    A value that many rows have covers a range of ranks. Exact ranks come from the histogram
    of whole seconds, which is joined by key and never holds more rows than seconds that occur.
    """
    lateness = seconds_between(F.col("event_time"), F.col("ingested_at")).alias("_seconds")
    dated = typed.withColumn("event_date", F.to_date("event_time"))
    histogram = dated.groupBy(*keys, lateness).agg(F.count("*").alias("_n"))
    joined = quantiles.join(histogram, list(keys))

    def rows_where(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("_n")).otherwise(0))

    below = rows_where(F.col("_seconds") < F.col("lateness_seconds")) / F.sum("_n")
    up_to = rows_where(F.col("_seconds") <= F.col("lateness_seconds")) / F.sum("_n")
    outside = F.greatest(below - F.col("share"), F.col("share") - up_to, F.lit(0.0))
    return joined.groupBy(*keys, "rows", "share", "lateness_seconds").agg(outside.alias("rank_error"))


def times_bound(error: Column, bound: float) -> Column:
    """How many whole times an error exceeds its bound: 0 for every estimate that keeps it."""
    return F.floor(error / bound).cast("long")
