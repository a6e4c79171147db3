"""Physical plans: what is shuffled, combined, broadcast, pushed down and pruned."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from eventstrata.operators.cohort import daily_metrics
from eventstrata.operators.dedup import dedup_input, silver_with_counts
from eventstrata.operators.incremental import events_of
from eventstrata.operators.lifecycle import reconstruct
from eventstrata.operators.validate import valid, validate
from eventstrata.session import scratch_path, stage
from eventstrata.config import StreamConfig
from eventstrata.sources.lines import number_lines, payload_lines, scan_lines
from helpers import bronze, event, silver

def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text: str) -> list[str]:
    return re.findall(r"Exchange (hashpartitioning\([^)]*\)|rangepartitioning|SinglePartition)", text)


@pytest.fixture
def nothing_small(spark):
    """As on big tables: only hinted sides are broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture(scope="module")
def stored(spark):
    rows = stage(validate(bronze(spark, event("e1"))), scratch_path(spark, "rows"))
    events = silver(spark, event("e1"))
    return rows, events


def test_validation_does_not_shuffle(spark):
    text = plan(validate(bronze(spark, event("e1"))))
    assert not re.search(r"Exchange (hash|range|Single)", text.replace("BroadcastExchange", ""))
    assert "BroadcastHashJoin" in text


def test_dedup_combines_before_each_of_two_shuffles(stored):
    text = plan(silver_with_counts(dedup_input(valid(stored[0]))))
    first, second = sorted(shuffles(text), key=len)
    assert first.startswith("hashpartitioning(event_id")
    for part in ("order_id", "event_type", "event_time", "rider_id", "supplier_id"):
        assert part in second
    assert len(re.findall(r"functions=\[partial_min", text)) == 2
    assert "Window" not in text


def test_payload_stays_out_of_the_dedup_scan(stored):
    scan = plan(silver_with_counts(dedup_input(valid(stored[0]))))
    schema = re.search(r"ReadSchema: \S+", scan).group()
    assert "_raw_payload" not in schema and "event_time_raw" not in schema
    assert "PushedFilters: [IsNull(reject_reason)]" in scan


def test_orders_join_on_existing_partitioning_and_prune_the_rider_scan(stored, nothing_small):
    text = plan(reconstruct(stored[1]))
    assert len(shuffles(text)) == 3
    assert "SortMergeJoin" in text and "BroadcastHashJoin" in text
    assert "partial_min" in text and "collect" not in text and "Expand" not in text
    assert "EqualTo(event_type,RIDER_ALLOCATED)" in text
    rider_scan = [s for s in re.findall(r"PushedFilters: \[.*?ReadSchema: \S+", text) if "RIDER" in s]
    assert all("struct<order_id:string,event_type:string,rider_id:string>" in s for s in rider_scan)


def test_daily_metrics_combine_before_the_shuffle(stored):
    orders = stage(reconstruct(stored[1]), scratch_path(stored[1].sparkSession, "orders"))
    text = plan(daily_metrics(orders))
    assert len(shuffles(text)) == 1 and "partial_count" in text
    assert "IsNotNull(created_at)" in text


def test_salted_selection_leaves_an_exchange_with_combining_behind_it(stored, nothing_small):
    ids = stored[1].select("order_id").distinct()
    rows = events_of(stored[1], ids, 2, StreamConfig(max_broadcast_ids=1))
    exchanges = shuffles(plan(rows.groupBy("order_id").agg(F.min("event_time"))))
    assert len([e for e in exchanges if "_salt" in e]) == 2
    assert re.match(r"hashpartitioning\(order_id#\d+, \d+\)", exchanges[0])


def test_landing_joins_numbers_only_and_moves_no_payload(spark, tmp_path, nothing_small):
    (tmp_path / "a.jsonl").write_text("{}\n\n{}\n")
    numbered = number_lines(payload_lines(scan_lines(spark, str(tmp_path))))
    text = plan(numbered)
    assert "BroadcastHashJoin" in text and not shuffles(text)
    offsets = re.findall(r"ReadSchema: struct<(_key:\S+)>", text)
    assert offsets == ["_key:bigint,_first:bigint,_last:bigint,_offset:bigint"]
    assert sorted(r["_source_row"] for r in numbered.collect()) == [1, 2]
