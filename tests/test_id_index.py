"""The id index: dates that cannot hold a batch's ids are not read, and no copy is missed."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from eventstrata.operators.incremental import dates_to_search, id_ranges, unseen_events
from eventstrata.session import scratch_path, stage
from eventstrata.sinks.tables import write_by_date

SCHEMA = (
    "event_id string, order_id string, event_type string, event_time timestamp_ntz, ingested_at timestamp_ntz, "
    "city string, rider_id string, supplier_id string, _payload_md5 string, _source_file string, _source_row long"
)
START = dt.datetime(2026, 9, 1, 12)


def typed(spark, rows):
    """Rows from (event id, day)."""
    made = [
        (name, "o", "ORDER_CREATED", START + dt.timedelta(day), START + dt.timedelta(day), None, None, None, "m", "f", i)
        for i, (name, day) in enumerate(rows)
    ]
    return spark.createDataFrame(made, SCHEMA)


def stored(spark, rows):
    index = typed(spark, rows).select("event_id", F.to_date("event_time").alias("event_date"))
    path = scratch_path(spark, "id-index")
    write_by_date(index, path, "event_date", ["event_id"])
    index = spark.read.schema(index.schema).parquet(path)
    return index, stage(id_ranges(index), scratch_path(spark, "ranges"))


def day(n):
    return (START + dt.timedelta(n)).date()


def test_counted_up_ids_read_only_the_dates_of_the_batch(spark):
    index, ranges = stored(spark, [(f"evt_{d:02}_{i:03}", d) for d in range(20) for i in range(30)])
    batch = typed(spark, [("evt_07_003", 7), ("evt_19_031", 19), ("evt_20_000", 20), ("evt_20_000", 20)])
    assert dates_to_search(batch, ranges, day(0)) == [day(7)]
    found = unseen_events(batch, index, day(0), ranges=ranges)
    assert sorted(r["event_id"] for r in found.collect()) == ["evt_19_031", "evt_20_000"]
    text = found._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", text)[1]
    assert "2026-09-08" in filters and "2026-09-09" not in filters
    assert dates_to_search(batch, ranges, day(8)) == []


@pytest.mark.parametrize("seed", range(3))
def test_no_copy_is_missed_whatever_the_ids(spark, seed):
    rng = random.Random(seed)
    rows = [(f"{rng.getrandbits(24):06x}" if seed else f"{d}{i}", d) for d in range(8) for i in range(40)]
    index, ranges = stored(spark, rows)
    # Copies come back under other dates as well, and some ids are new.
    again = [(name, rng.randrange(9)) for name, _ in rng.sample(rows, 60)] + [(f"zz{i}", 8) for i in range(5)]
    batch = typed(spark, again)
    whole = sorted(map(str, unseen_events(batch, index, day(0)).collect()))
    assert sorted(map(str, unseen_events(batch, index, day(0), ranges=ranges).collect())) == whole
    assert len(whole) == 5


def test_empty_sides(spark):
    index, ranges = stored(spark, [("a", 0)])
    nothing = typed(spark, [])
    assert dates_to_search(nothing, ranges, day(0)) == []
    assert unseen_events(nothing, index, day(0), ranges=ranges).count() == 0
    batch = typed(spark, [("a", 0), ("b", 1)])
    none = ranges.where("false")
    assert unseen_events(batch, index.where("false"), day(0), ranges=none).count() == 2
