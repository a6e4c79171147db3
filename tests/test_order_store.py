"""The bucketed order store against a full rebuild: results, and what it reads and rewrites."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from eventstrata.config import StreamConfig
from eventstrata.operators.lifecycle import reconstruct
from eventstrata.operators.order_store import BUCKET, OrderStore
from eventstrata.session import scratch_path
from helpers import event, silver


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def stream(spark):
    lines = []
    for i in range(120):
        lines.append(event(f"c{i}", order_id=f"o{i}", city=f"city{i % 3}"))
        lines.append(event(f"a{i}", "RIDER_ALLOCATED", "10:01:00Z", order_id=f"o{i}", rider_id=f"r{i % 5}"))
    late = [event("late1", "DELIVERED", "11:00:00Z", order_id="o7"), event("new1", order_id="o500")]
    return silver(spark, *lines, *late).cache()


def files(path):
    return {p.relative_to(path): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


@pytest.fixture
def store(spark, stream):
    store = OrderStore(spark, scratch_path(spark, "store").removeprefix("file:"), StreamConfig(order_buckets=16))
    store.load(stream.where("event_id not in ('late1', 'new1')"))
    return store


def test_only_touched_buckets_are_read_and_rewritten(spark, stream, store):
    before = files(store.orders_path)
    events_before = files(store.events_path)
    batch = stream.where("event_id in ('late1', 'new1')")
    touched = store.refresh(batch, 1)
    wanted = {r[0] for r in batch.select(store.bucket()).collect()}
    assert touched == sorted(wanted) and len(touched) <= 2
    after = files(store.orders_path)
    changed = {f for f in before | after if before.get(f) != after.get(f)}
    assert {int(re.search(rf"{BUCKET}=(\d+)", str(f))[1]) for f in changed} == wanted
    assert events_before.items() <= files(store.events_path).items()
    assert rows(store.orders()) == rows(reconstruct(stream))


def test_a_refresh_prunes_folders_before_reading(store, spark):
    pruned = store.events([3, 5])
    text = pruned._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"PartitionFilters: \[[^\]]*{BUCKET}#\d+ IN \(3,5\)", text)
    scanned = pruned.select(F.col("_metadata.file_path").alias("f")).distinct().collect()
    assert {re.search(rf"{BUCKET}=(\d+)", r["f"])[1] for r in scanned} <= {"3", "5"}


def test_repeating_a_batch_changes_nothing(stream, store):
    batch = stream.where("event_id in ('late1', 'new1')")
    first = store.refresh(batch, 1)
    before = rows(store.orders()), rows(store.events())
    assert store.refresh(batch, 1) == first
    assert (rows(store.orders()), rows(store.events())) == before
    assert store.refresh(batch.where("false"), 2) == []
    assert rows(store.orders()) == before[0]
