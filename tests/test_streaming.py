"""Streams against batch, over many micro-batches."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from eventstrata.catalog import queries
from eventstrata.config import SEMANTIC_KEY
from eventstrata.operators.compare import membership_differences
from eventstrata.session import scratch_path
from eventstrata.streaming import events as streams
from eventstrata.streaming import state
from eventstrata.streaming.batches import BatchTable
from eventstrata.operators.dedup import dedup_input, silver_with_counts
from eventstrata.operators.validate import valid, validate
from eventstrata.sources.lines import land_files
from helpers import bronze, event, staged_folders
from test_run import write_stream


def batch_typed(spark, source):
    return dedup_input(valid(validate(land_files(spark, source))))


def test_dedup_over_micro_batches_matches_batch_keys(spark, tmp_path):
    source = write_stream(spark, tmp_path / "in", 6)
    silver, seen, expired = (scratch_path(spark, n) for n in ("silver", "seen", "expired"))
    rows = streams.stream_valid(spark, source, files_per_trigger=1)
    handler = streams.deduplicate_batches(silver, seen, expired, horizon_days=60)
    streams.each_batch(rows, handler, scratch_path(spark, "progress")).awaitTermination()
    batch = silver_with_counts(batch_typed(spark, source))
    stored = spark.read.parquet(silver)
    assert stored.select("batch_id").distinct().count() == 6
    assert stored.count() == batch.count()
    assert membership_differences(stored, batch, SEMANTIC_KEY).count() == 0
    assert spark.read.parquet(expired).count() == 0


def test_rows_behind_the_horizon_are_set_aside_and_retries_overwrite(spark, tmp_path):
    source = write_stream(spark, tmp_path / "in", 1)
    typed = batch_typed(spark, source)
    silver, seen, expired = (scratch_path(spark, n) for n in ("silver", "seen", "expired"))
    handler = streams.deduplicate_batches(silver, seen, expired, horizon_days=5)
    handler(typed, 0)
    kept, aside = spark.read.parquet(silver).count(), spark.read.parquet(expired).count()
    assert aside > 0
    expected = typed.where("to_date(event_time) >= DATE '2024-01-25'")
    assert kept == silver_with_counts(expected).count()
    assert aside == typed.count() - expected.count()
    handler(typed, 1)
    handler(typed, 1)
    assert spark.read.parquet(silver).count() == kept


def test_late_rows_go_to_their_own_sink(spark, tmp_path):
    source = write_stream(spark, tmp_path / "in", 3)
    on_time, late = scratch_path(spark, "on-time"), scratch_path(spark, "late")
    rows = streams.stream_valid(spark, source, files_per_trigger=1)
    handler = streams.route_by_lateness(on_time, late, 100)
    streams.each_batch(rows, handler, scratch_path(spark, "progress")).awaitTermination()
    assert spark.read.parquet(on_time).agg({"lateness_seconds": "max"}).first()[0] <= 100
    assert spark.read.parquet(late).agg({"lateness_seconds": "min"}).first()[0] > 100
    total = spark.read.parquet(on_time).count() + spark.read.parquet(late).count()
    assert total == batch_typed(spark, source).count()


def test_restarted_stream_takes_only_new_files(spark, tmp_path):
    source = write_stream(spark, tmp_path / "in", 2)
    out, progress = scratch_path(spark, "validated"), scratch_path(spark, "progress")
    for _ in range(2):
        rows = streams.stream_validated(streams.stream_bronze(spark, source))
        streams.append_to(rows, out, progress).awaitTermination()
    assert spark.read.parquet(out).count() == 1055
    Path(source, "more.jsonl").write_text("{broken\n")
    rows = streams.stream_validated(streams.stream_bronze(spark, source))
    streams.append_to(rows, out, progress).awaitTermination()
    assert spark.read.parquet(out).count() == 1056


def test_a_clock_that_runs_ahead_does_not_expire_later_events(spark):
    silver, seen, expired = (scratch_path(spark, n) for n in ("silver", "seen", "expired"))
    handler = streams.deduplicate_batches(silver, seen, expired, horizon_days=30)
    days = ["2026-09-03", "2031-01-01", "2026-09-04", "2026-09-05"]
    for i, day in enumerate(days):
        arrival = "2026-09-04T00:00:00Z" if day.startswith("2031") else f"{day}T10:00:05Z"
        line = event(f"e{i}", event_time=f"{day}T10:00:00Z", ingested_at=arrival, order_id=f"o{i}")
        handler(dedup_input(valid(validate(bronze(spark, line)))), i)
    assert {r["event_id"] for r in spark.read.parquet(silver).collect()} == {"e0", "e1", "e2", "e3"}
    assert spark.read.parquet(expired).count() == 0


def test_stored_batches_are_pruned_by_date_and_staged_rows_removed(spark, tmp_path):
    source = write_stream(spark, tmp_path / "in", 1)
    typed = batch_typed(spark, source)
    silver, seen, expired = (str(tmp_path / n) for n in ("silver", "seen", "expired"))
    handler = streams.deduplicate_batches(silver, seen, expired, horizon_days=5)
    before = staged_folders(spark)
    handler(typed, 0)
    assert staged_folders(spark) == before
    days = {p.name for p in Path(seen).glob("batch_id=0/event_date=*")}
    assert min(days) == "event_date=2024-01-25" and max(days) == "event_date=2024-01-30"
    like = spark.read.parquet(seen).drop("batch_id")
    stored = BatchTable(spark, seen, like.schema).before(1).where("event_date >= DATE '2024-01-28'")
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_state_dedup_matches_batch_keys_with_a_hot_id_combined(spark, tmp_path):
    source = write_stream(spark, tmp_path / "in", 4)
    more = Path(source, "part-0.jsonl").read_text().split("\n")[0]
    Path(source, "storm.jsonl").write_text("\n".join([more] * 500))
    combined, out = scratch_path(spark, "combined"), scratch_path(spark, "unique")
    rows = streams.stream_valid(spark, source, files_per_trigger=2)
    streams.each_batch(rows, state.combine_batches(combined), scratch_path(spark, "progress")).awaitTermination()
    stored = spark.read.parquet(combined)
    assert stored.groupBy("batch_id", "event_id").count().where("count > 1").count() == 0
    unique = state.unique_in_state(spark, combined, stored.drop("batch_id").schema, 60, files_per_trigger=3)
    streams.append_to(unique, out, scratch_path(spark, "progress")).awaitTermination()
    batch = silver_with_counts(batch_typed(spark, source))
    assert spark.read.parquet(out).count() == batch.count()
    assert membership_differences(spark.read.parquet(out), batch, SEMANTIC_KEY).count() == 0


def test_state_falls_behind_the_horizon(spark, tmp_path):
    combined, out = str(tmp_path / "combined"), scratch_path(spark, "unique")
    handler = state.combine_batches(combined)
    for day in range(1, 13):
        at = f"2026-09-{day:02}T10:00:00Z"
        lines = [event(f"e{day}-{i}", event_time=at, ingested_at=at, order_id=f"o{day}-{i}") for i in range(20)]
        # Yesterday's events are sent again under their ids and under fresh ones.
        before = f"2026-09-{day - 1:02}T10:00:00Z"
        lines += [event(f"e{day - 1}-{i}", event_time=before, ingested_at=at, order_id=f"o{day - 1}-{i}") for i in range(5) if day > 1]
        lines += [event(f"x{day}-{i}", event_time=before, ingested_at=at, order_id=f"o{day - 1}-{i}") for i in range(5) if day > 1]
        handler(dedup_input(valid(validate(bronze(spark, *lines)))).coalesce(1), day - 1)
    schema = spark.read.parquet(combined).drop("batch_id").schema
    unique = state.unique_in_state(spark, combined, schema, 3, files_per_trigger=1)
    stream = streams.append_to(unique, out, scratch_path(spark, "progress"))
    stream.awaitTermination()
    rows = [[op["numRowsTotal"] for op in p["stateOperators"]] for p in stream.recentProgress if p["stateOperators"]]
    ids = 20 * 12 + 5 * 11
    assert 0 < max(r[0] for r in rows[-4:]) < ids / 2
    kept = spark.read.parquet(out)
    assert kept.count() == kept.select("order_id").distinct().count() == 20 * 12


def test_dedup_with_compaction_matches_batch_keys(spark, tmp_path):
    source = write_stream(spark, tmp_path / "in", 7)
    silver, seen, expired = (scratch_path(spark, n) for n in ("silver", "seen", "expired"))
    rows = streams.stream_valid(spark, source, files_per_trigger=1)
    handler = streams.deduplicate_batches(silver, seen, expired, horizon_days=60, compact_every=2)
    streams.each_batch(rows, handler, scratch_path(spark, "progress")).awaitTermination()
    batch = silver_with_counts(batch_typed(spark, source))
    runs = BatchTable(spark, silver, batch.schema, 2).runs()
    stored = BatchTable(spark, silver, spark.read.parquet(runs[0][2]).schema, 2).before(7)
    assert [r[:2] for r in runs] == [(0, 3), (4, 5)]
    assert stored.count() == batch.count()
    assert membership_differences(stored, batch, SEMANTIC_KEY).count() == 0


def test_files_per_date_stay_bounded_over_fifty_batches(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), None, 4)
    rows = spark.range(4).selectExpr("id", "date_add(DATE '2026-09-01', cast(id % 2 as int)) AS event_date")
    table.schema = rows.schema
    folders, most = [], 0
    for n in range(50):
        table.compact(n)
        table.write(rows.withColumn("id", F.col("id") + 10 * n), n)
        assert n % 10 or table.before(n + 1).count() == 4 * (n + 1)
        read = table.before(n + 1).inputFiles()
        most = max(most, len([f for f in read if "event_date=2026-09-01" in f]))
        folders.append(len(list((tmp_path / "t").glob("batch_id=*"))))
    # At most three runs on each of three tiers and four fresh batches; one file each.
    assert most <= 3 * 3 + 4 and max(folders) <= 9
    kept = table.before(50)
    assert kept.count() == kept.distinct().count() == 200
    assert len(list((tmp_path / "t-runs" / "_generations").iterdir())) <= 12
    # A retry of the batch behind a compaction sees the same rows before it.
    again = BatchTable(spark, table.path, rows.schema, 4)
    assert again.before(49).count() == 196
    table.write(rows.withColumn("id", F.col("id") + 490), 49)
    assert again.before(50).distinct().count() == 200


def test_compaction_that_breaks_off_loses_nothing(spark, tmp_path, monkeypatch):
    rows = spark.range(3).selectExpr("id", "DATE '2026-09-01' AS event_date")
    table = BatchTable(spark, str(tmp_path / "t"), rows.schema, 2)
    for n in range(4):
        table.write(rows, n)

    def fail(*args):
        raise OSError("gone")

    with monkeypatch.context() as patch:
        patch.setattr(table.store, "publish", fail)
        with pytest.raises(OSError):
            table.compact(4)
    assert table.before(4).count() == 12 and table.runs() == []
    assert table.compact(4) and not table.compact(4)
    assert table.before(4).count() == 12
    with pytest.raises(ValueError, match="at least two"):
        BatchTable(spark, table.path, rows.schema, 1)


def many_small_files(spark, path):
    """An events table of 40 rows that land in 40 files; a multiple of 29 and of 50 is sent again."""
    start = dt.datetime(2024, 1, 1)
    rows = [(4096 * i, start + dt.timedelta(hours=i), i, "view", float(i * 7 % 300)) for i in range(40)]
    table = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")
    table.coalesce(1).write.parquet(f"{path}/events.parquet")
    return str(path)


def batches_of(files):
    return {f.split("batch_id=")[1].split("/")[0] for f in files}


def test_a_backlog_of_small_files_takes_a_bounded_number_of_deduplications(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "MOST_BATCHES", 2)
    source = many_small_files(spark, tmp_path / "sf")
    found = queries.REGISTRY["stream_dedup"](spark, source)
    assert len(batches_of(found.inputFiles())) == 2
    batch = queries.Layers(spark, source).silver
    assert found.count() == batch.count() > 30
    assert membership_differences(found, batch, SEMANTIC_KEY).count() == 0


def test_a_backlog_of_small_files_is_routed_in_a_bounded_number_of_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "MOST_BATCHES", 2)
    source = many_small_files(spark, tmp_path / "sf")
    found = queries.REGISTRY["late_side_output"](spark, source)
    assert len(batches_of(found.inputFiles())) == 2
    assert found.count() == queries.Layers(spark, source).typed.count() > 30
    assert {r["side"] for r in found.select("side").distinct().collect()} == {"on time", "late"}


def test_a_backlog_of_small_files_reaches_the_state_in_a_bounded_number_of_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "MOST_BATCHES", 2)
    handled = []

    def combine(path):
        handle = combine_batches(path)

        def counted(rows, batch_id):
            handled.append(batch_id)
            handle(rows, batch_id)

        return counted

    combine_batches = state.combine_batches
    monkeypatch.setattr(state, "combine_batches", combine)
    source = many_small_files(spark, tmp_path / "sf")
    found = queries.REGISTRY["stream_dedup_state"](spark, source)
    assert handled == [0, 1]
    batch = queries.Layers(spark, source).silver
    assert found.count() == batch.count() > 30
    assert membership_differences(found, batch, SEMANTIC_KEY).count() == 0
