"""Validation, deduplication, lifecycle and cohort semantics on hand-written events."""

from __future__ import annotations

import datetime as dt

from eventstrata.config import DEFAULT, EventType, StreamConfig
from eventstrata.operators.cohort import daily_metrics
from eventstrata.operators.compare import fingerprint, membership_differences
from eventstrata.operators.incremental import events_of, replay, with_event_type
from eventstrata.operators.lifecycle import reconstruct
from eventstrata.operators.validate import rejected, validate
from helpers import DAY, bronze, column, event, silver

import pytest


def order(spark, *events):
    rows = reconstruct(silver(spark, *events)).collect()
    assert len(rows) == 1
    return rows[0]


def test_one_reason_per_bad_row_first_failure_wins(spark):
    lines = [
        "{broken",
        "null",
        event("  "),
        event("e1", order_id=None, event_type="NOPE"),
        event("e2", event_type="NOPE", event_time="bad"),
        event("e3", event_type=None),
        event("e4", event_type=" DELIVERED "),
        event("e5", event_type="delivered"),
        event("e6", event_time="now"),
        event("e7", ingested_at=None),
        event("e8", event_time=None, ingested_at=None),
    ]
    assert column(validate(bronze(spark, *lines)), "reject_reason", "_source_row") == [
        "UNPARSEABLE_JSON",
        "MISSING_EVENT_ID",
        "MISSING_EVENT_ID",
        "MISSING_ORDER_ID",
        "UNKNOWN_EVENT_TYPE",
        "UNKNOWN_EVENT_TYPE",
        None,
        "UNKNOWN_EVENT_TYPE",
        "INVALID_EVENT_TIME",
        "INVALID_INGESTED_AT",
        "INVALID_EVENT_TIME",
    ]


def test_quarantine_keeps_raw_values(spark):
    row = rejected(validate(bronze(spark, event("e1", event_time="bad")))).first()
    assert row["event_time_raw"] == "bad"
    assert row["ingested_at_raw"] == DAY + "10:00:00Z"
    assert '"event_id": "e1"' in row["_raw_payload"]


def test_replay_under_a_wider_vocabulary(spark):
    bad = rejected(validate(bronze(spark, event("e1", "TELEPORTED"), event("e2", "NOPE"))))
    wider = with_event_type(DEFAULT, EventType("TELEPORTED", 7, "teleported_at"))
    assert column(replay(bad, wider), "reject_reason", "event_id") == [None, "UNKNOWN_EVENT_TYPE"]


def test_copies_of_rejected_rows_are_not_duplicates(spark):
    bad = event("e1", "NOPE")
    assert rejected(validate(bronze(spark, bad, bad))).count() == 2


def test_exact_duplicate_keeps_earliest_arrival(spark):
    rows = silver(
        spark,
        event("e1", city="late", ingested_at=DAY + "10:00:09Z"),
        event("e1", city="early", ingested_at=DAY + "10:00:01Z"),
        event("e1", city="late", ingested_at=DAY + "10:00:09Z"),
    ).collect()
    assert [(r["city"], r["_valid_rows"], r["_exact_survivors"]) for r in rows] == [("early", 3, 1)]


def test_semantic_tie_keeps_smallest_id_and_ignores_city(spark):
    rows = silver(spark, event("evt_1", city="a"), event("dup_1", city="b")).collect()
    assert [(r["event_id"], r["city"], r["_exact_survivors"]) for r in rows] == [("dup_1", "b", 2)]


def test_reallocations_survive_and_null_riders_match(spark):
    rows = silver(
        spark,
        event("e1", "RIDER_ALLOCATED", "10:00:00Z", rider_id="r1"),
        event("e2", "RIDER_ALLOCATED", "10:00:00Z", rider_id="r2"),
        event("e3", "RIDER_ALLOCATED", "10:01:00Z", rider_id="r1"),
        event("e4", "RIDER_ALLOCATED", "10:02:00Z"),
        event("e5", "RIDER_ALLOCATED", "10:02:00Z"),
    )
    assert sorted(r["event_id"] for r in rows.collect()) == ["e1", "e2", "e3", "e4"]
    row = reconstruct(rows).first()
    assert (row["allocation_attempts"], row["unique_riders"], row["event_count"]) == (4, 2, 4)


def test_lateness_flag_is_strict(spark):
    rows = silver(
        spark,
        event("e1", event_time=DAY + "00:00:00Z", ingested_at=DAY + "00:05:00.5Z"),
        event("e2", event_time=DAY + "00:00:00.1Z", ingested_at=DAY + "00:05:01.05Z"),
        event("e3", event_time=DAY + "00:05:00.1Z", ingested_at=DAY + "00:00:00.9Z"),
    )
    assert column(rows, "lateness_seconds", "event_id") == [300, 301, -300]
    assert column(rows, "is_late", "event_id") == [False, True, False]


@pytest.mark.parametrize(
    ("events", "status"),
    [
        ([("DELIVERED", "09:00:00Z"), ("DELIVERED", "11:00:00Z"), ("CANCELLED", "10:00:00Z")], "CANCELLED"),
        ([("DELIVERED", "10:00:00Z"), ("CANCELLED", "10:00:00Z")], "DELIVERED"),
        ([("DELIVERED", "10:00:01Z"), ("CANCELLED", "10:00:00Z")], "DELIVERED"),
        ([("DELIVERED", "10:00:00Z")], "DELIVERED"),
        ([("CANCELLED", "10:00:00Z")], "CANCELLED"),
        ([("ORDER_CREATED", "10:00:00Z")], "OPEN"),
    ],
)
def test_final_status(spark, events, status):
    rows = [event(f"e{i}", kind, at) for i, (kind, at) in enumerate(events)]
    assert order(spark, *rows)["final_status"] == status


def test_city_falls_back_and_supplier_is_the_latest(spark):
    row = order(
        spark,
        event("e1", supplier_id="s1"),
        event("e2", "RIDER_ALLOCATED", "10:01:00Z", supplier_id="s2", city="b", rider_id="r"),
        event("e3", "DELIVERED", "10:02:00Z", city="c"),
    )
    assert (row["city"], row["supplier_id"]) == ("b", "s2")
    assert row["started_pickup_at"] is None


def test_creation_city_beats_an_earlier_event(spark):
    row = order(
        spark,
        event("e0", "RIDER_ALLOCATED", "09:00:00Z", city="early"),
        event("e1", city="created"),
    )
    assert row["city"] == "created"


def test_same_instant_is_ordered_by_lifecycle_rank(spark):
    row = order(
        spark,
        event("a", "DELIVERED", supplier_id="last", city="z"),
        event("b", "RIDER_ALLOCATED", supplier_id="first", city="y"),
    )
    assert (row["city"], row["supplier_id"]) == ("y", "last")


def test_rates_are_null_without_denominator_and_uncreated_orders_stay_out(spark):
    rows = silver(
        spark,
        event("e1"),
        event("e2", "RIDER_ACCEPTED", "10:01:00Z"),
        event("e3", "DELIVERED", order_id="o2"),
    )
    days = daily_metrics(reconstruct(rows)).collect()
    assert len(days) == 1
    day = days[0]
    assert day["date"] == dt.date(2026, 9, 3)
    assert (day["orders_created"], day["orders_accepted"], day["orders_allocated"]) == (1, 1, 0)
    assert (day["fulfilment_rate"], day["acceptance_rate"]) == (0.0, None)


def test_empty_input(spark):
    rows = silver(spark)
    assert rows.count() == 0
    assert reconstruct(rows).count() == 0
    assert daily_metrics(reconstruct(rows)).count() == 0


def test_salted_and_broadcast_selection_agree(spark):
    rows = silver(
        spark, *[event(f"e{i}", at=f"10:00:{i:02}Z", order_id=f"o{i % 4}") for i in range(40)]
    )
    ids = spark.createDataFrame([("o1",), ("o3",)], "order_id string")
    few = events_of(rows, ids, 2)
    many = events_of(rows, ids, 2, StreamConfig(max_broadcast_ids=1))
    assert few.count() == 20
    assert few.columns == many.columns
    assert membership_differences(few, many, ["event_id"]).count() == 0


def test_fingerprint_ignores_order_and_sees_values(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "n int, t string")
    b = spark.createDataFrame([(2, None), (1, "x")], "n int, t string")
    c = spark.createDataFrame([(2, ""), (1, "x")], "n int, t string")
    assert fingerprint(a).first() == fingerprint(b).first() != fingerprint(c).first()


def test_config_is_checked():
    twice = (*DEFAULT.event_types, DEFAULT.event_types[0])
    with pytest.raises(ValueError, match="unique"):
        StreamConfig(event_types=twice)
    with pytest.raises(ValueError, match="role"):
        StreamConfig(creation="NOPE")
    with pytest.raises(ValueError, match="fields"):
        StreamConfig(fields=DEFAULT.fields[1:])
