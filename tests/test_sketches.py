"""Sketches against exact figures at two scales, and that a too small one is found out."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from eventstrata.operators import sketches
from eventstrata.operators.sketches import SketchSize
from eventstrata.session import scratch_path
from eventstrata.sinks.tables import write_by_date


def typed(spark, rows, repeat=3):
    """Rows over thirty days and three types, ids repeated, lateness with a long tail."""
    n = F.col("id")
    start = F.lit("2026-09-01 00:00:00").cast("timestamp_ntz")
    event_time = F.timestamp_add("SECOND", (n % 2_592_000).cast("int"), start)
    late = F.pow(F.pmod(F.xxhash64("id"), F.lit(1000)) / 100, 3).cast("int")
    return spark.range(rows).select(
        F.concat(F.lit("e"), F.floor(n / repeat)).alias("event_id"),
        F.element_at(F.array(*map(F.lit, "abc")), (n % 3 + 1).cast("int")).alias("event_type"),
        event_time.alias("event_time"),
        F.timestamp_add("SECOND", late, event_time).alias("ingested_at"),
    )


def stored(spark, rows, size=sketches.DEFAULT_SIZE):
    built, path = sketches.daily_sketches(rows, size), scratch_path(spark, "sketches")
    write_by_date(built, path, "event_date", ["event_type"])
    return spark.read.schema(built.schema).parquet(path)


@pytest.mark.parametrize("rows", [20_000, 600_000])
def test_errors_stay_within_their_bounds(spark, rows):
    size, table = sketches.DEFAULT_SIZE, typed(spark, rows)
    kept = stored(spark, table)
    for keys in ((), ("event_date",), ("event_type",)):
        found = sketches.distinct_error(kept, table, *keys).collect()
        assert found and max(r["relative_error"] for r in found) < size.distinct_error
    shares = [0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    found = sketches.rank_errors(sketches.lateness_quantiles(kept, shares, "event_type"), table, "event_type").collect()
    assert len(found) == 3 * len(shares)
    assert max(r["rank_error"] for r in found) < size.rank_error


def test_too_small_sketches_exceed_their_bounds(spark):
    small, table = SketchSize(log_buckets=4, quantile_k=8), typed(spark, 200_000)
    kept = stored(spark, table, small)
    ids = sketches.distinct_error(kept, table, "event_date")
    over = sketches.times_bound(F.col("relative_error"), sketches.DEFAULT_SIZE.distinct_error)
    assert ids.where(over > 0).count() > 0
    shares = [i / 50 for i in range(1, 50)]
    ranks = sketches.rank_errors(sketches.lateness_quantiles(kept, shares, "event_type"), table, "event_type")
    assert ranks.where(sketches.times_bound(F.col("rank_error"), 0.02) > 0).count() > 0


def test_sketches_do_not_grow_with_the_rows(spark):
    def largest(rows):
        kept = sketches.daily_sketches(typed(spark, rows))
        return kept.agg(F.max(F.octet_length("ids") + F.octet_length("lateness"))).first()[0]

    assert largest(2_000_000) < 30_000


def test_no_rows(spark):
    table = typed(spark, 0)
    assert sketches.daily_sketches(table).count() == 0
    assert sketches.distinct_ids(sketches.daily_sketches(table), "event_date").count() == 0
