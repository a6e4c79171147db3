"""The whole run: landing from files, publishing, gate, determinism."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from eventstrata import ReconciliationError, StreamConfig, run
from eventstrata.catalog.delivery_stream import physical_lines
from eventstrata.config import LAYOUT
from eventstrata.operators import quality
from eventstrata.operators.compare import fingerprint
from eventstrata.operators.dedup import SILVER_COLUMNS
from eventstrata.operators.lifecycle import order_columns
from eventstrata.operators.validate import QUARANTINE_COLUMNS
from eventstrata.plans import job
from eventstrata.session import scratch_path, stage, workspace
from eventstrata.sources.lines import land_files
from helpers import ROOT, TESTDATA, event, staged_folders

TABLES = [name for name in LAYOUT if name != "report"]


def write_stream(spark, folder: Path, parts: int, descending: bool = False) -> str:
    """The derived stream as plain text files, cut and ordered as asked."""
    order = F.col("line").desc() if descending else F.col("line")
    rows = physical_lines(spark, f"{TESTDATA}/sf0.001").orderBy(order, "slot").collect()
    folder.mkdir(parents=True)
    for part in range(parts):
        text = "".join(r["value"] + "\n" for r in rows[part::parts])
        (folder / f"part-{part}.jsonl").write_text(text, encoding="utf-8", newline="")
    return str(folder)


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("run")
    source = write_stream(spark, base / "in", 1)
    report = run(spark, source, str(base / "out"))
    return source, report, base / "out"


def read(spark, out, name):
    return spark.read.parquet(f"{out}/{LAYOUT[name]}")


# Counts of the derived stream at the smallest scale, listed in FIXTURES.md.
EXPECTED = {
    "raw_events": 1055,
    "silver_events": 891,
    "rejected_events": 119,
    "duplicate_events_removed": 45,
    "late_events": 1,
    "unique_orders": 167,
    "delivered_orders": 109,
    "cancelled_orders": 29,
    "open_orders": 29,
    "exact_duplicates_removed": 28,
    "semantic_duplicates_removed": 17,
    "orders_missing_created_at": 49,
    "reporting_days": 30,
}
EXPECTED_REASONS = {
    "UNPARSEABLE_JSON": 10,
    "MISSING_EVENT_ID": 10,
    "MISSING_ORDER_ID": 10,
    "UNKNOWN_EVENT_TYPE": 72,
    "INVALID_EVENT_TIME": 9,
    "INVALID_INGESTED_AT": 8,
}


def test_report_values(finished):
    _, report, _ = finished
    assert {k: report[k] for k in EXPECTED} == EXPECTED
    assert report["rejected_by_reason"] == EXPECTED_REASONS
    assert tuple(report) == quality.REPORT_FIELDS


def test_report_file_equals_returned_report_and_has_no_clock(finished):
    _, report, out = finished
    (part,) = (out / LAYOUT["report"]).glob("part-*.json")
    stored = json.loads(part.read_text())
    assert stored == report
    assert list(stored) == list(quality.REPORT_FIELDS)
    assert all(isinstance(v, (int, float, dict)) for v in stored.values())


def test_contract_columns(spark, finished):
    _, _, out = finished
    assert read(spark, out, "bronze").columns[:4] == [
        "_source_row",
        "_source_file",
        "_raw_payload",
        "_is_valid_json",
    ]
    assert read(spark, out, "orders").columns == list(order_columns())
    assert read(spark, out, "silver").columns == list(SILVER_COLUMNS)
    assert read(spark, out, "quarantine").columns == list(QUARANTINE_COLUMNS)
    types = dict(read(spark, out, "silver").dtypes)
    assert types["event_time"] == types["ingested_at"] == "timestamp_ntz"
    assert (types["event_date"], types["lateness_seconds"], types["is_late"]) == (
        "date",
        "bigint",
        "boolean",
    )


def test_bronze_is_lossless_and_numbered(spark, finished):
    source, report, out = finished
    text = Path(source, "part-0.jsonl").read_text(encoding="utf-8")
    spaces = " \u00a0"
    kept = [line.strip("\r") for line in text.split("\n")]
    kept = [line for line in kept if line.strip(spaces)]
    rows = read(spark, out, "bronze").orderBy("_source_row").collect()
    assert [r["_raw_payload"] for r in rows] == kept
    assert [r["_source_row"] for r in rows] == list(range(1, report["raw_events"] + 1))
    assert {r["_source_file"] for r in rows} == {"part-0.jsonl"}


def part_rows(folder: Path):
    import pyarrow.parquet as pq

    return [r for p in sorted(folder.glob("part-*")) for r in pq.read_table(p).to_pylist()]


@pytest.mark.parametrize(
    ("name", "keys"),
    [
        ("bronze", ["_source_row"]),
        ("quarantine", ["_source_row"]),
        ("silver", ["order_id", "event_time", "event_id"]),
        ("orders", ["order_id"]),
        ("daily", ["date"]),
    ],
)
def test_part_files_are_in_total_order(finished, name, keys):
    _, _, out = finished
    stored = [tuple(r[k] for k in keys) for r in part_rows(out / LAYOUT[name])]
    assert stored == sorted(stored)
    assert len(set(stored)) == len(stored)


def test_second_run_is_identical_and_overwrites(spark, finished):
    source, report, out = finished
    before = {n: part_rows(out / LAYOUT[n]) for n in TABLES}
    assert run(spark, source, str(out)) == report
    assert {n: part_rows(out / LAYOUT[n]) for n in TABLES} == before


def test_result_ignores_input_order_file_cuts_and_partitions(spark, finished, tmp_path):
    _, report, out = finished
    source = write_stream(spark, tmp_path / "in", 5, descending=True)
    settings = {"spark.sql.shuffle.partitions": "13", "spark.sql.files.maxPartitionBytes": "20000"}
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        assert run(spark, source, str(tmp_path / "out")) == report
        for name in ("silver", "orders", "daily"):
            first, second = (
                fingerprint(read(spark, o, name).drop("_source_row", "_source_file")).first()
                for o in (out, tmp_path / "out")
            )
            assert first == second
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.mark.parametrize("max_broadcast_blocks", [500_000, 0])
def test_ordinals_over_many_blocks_per_file(spark, tmp_path, max_broadcast_blocks):
    lines = [[f'{{"event_id":"{f}-{i}"}}' for i in range(900 + f)] for f in range(3)]
    for f, texts in enumerate(lines):
        body = "\n".join("\n \n\r\n".join(texts[i : i + 7]) for i in range(0, len(texts), 7))
        (tmp_path / f"f{f}.txt").write_text(body, newline="")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        config = StreamConfig(max_broadcast_blocks=max_broadcast_blocks, min_partition_bytes=1000)
        landed = land_files(spark, str(tmp_path), config)
        got = {(r["_source_file"], r["_source_row"]): r["event_id"] for r in landed.collect()}
        assert landed.rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {
        (f"f{f}.txt", i + 1): f"{f}-{i}" for f, texts in enumerate(lines) for i in range(len(texts))
    }


def test_different_split_between_the_scans_is_refused(spark, tmp_path):
    (tmp_path / "f.txt").write_text("\n".join(f'{{"event_id":"{i}"}}' for i in range(2000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    landed = land_files(spark, str(tmp_path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        with pytest.raises(Exception, match="split differently"):
            landed.select("*").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_gate_withholds_silver_gold_and_report(spark, finished, tmp_path, monkeypatch):
    source, _, _ = finished
    honest = quality.silver_counts
    monkeypatch.setattr(job.quality, "silver_counts", lambda s: honest(s.limit(10)))
    with pytest.raises(ReconciliationError, match="raw_events=1055"):
        run(spark, source, str(tmp_path / "out"))
    written = {name for name, rel in LAYOUT.items() if (tmp_path / "out" / rel).exists()}
    assert written == {"bronze", "quarantine"}


@pytest.mark.parametrize("fault", ["lost", "doubled"])
def test_gate_sees_rows_lost_or_doubled_in_validation(spark, finished, tmp_path, monkeypatch, fault):
    source, _, _ = finished
    honest = job.validate

    def faulty(bronze, config):
        rows = honest(bronze, config)
        return rows.where("_source_row % 2 = 0") if fault == "lost" else rows.unionByName(rows)

    monkeypatch.setattr(job, "validate", faulty)
    with pytest.raises(ReconciliationError, match="raw_events=1055"):
        run(spark, source, str(tmp_path / "out"))
    written = {name for name, rel in LAYOUT.items() if (tmp_path / "out" / rel).exists()}
    assert written == {"bronze", "quarantine"}


def test_empty_input(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "empty.jsonl").write_text("\n \n\r\n")
    report = run(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert report["raw_events"] == report["silver_events"] == report["reporting_days"] == 0
    assert report["late_event_rate"] is None
    assert report["rejected_by_reason"] == {}
    for name in TABLES:
        assert read(spark, tmp_path / "out", name).count() == 0


@pytest.mark.parametrize("orders", [1, 2, 25])
def test_few_orders(spark, tmp_path, orders):
    steps = ["ORDER_CREATED", "RIDER_ALLOCATED", "RIDER_ACCEPTED", "DELIVERED"]
    lines = [
        event(f"e{o}-{i}", step, f"10:0{i}:00Z", order_id=f"o{o}", rider_id=f"r{o}")
        for o in range(orders)
        for i, step in enumerate(steps[: 1 + o % 4])
    ]
    (tmp_path / "in.jsonl").write_text("\n".join(json.dumps(line) for line in lines))
    report = run(spark, str(tmp_path / "in.jsonl"), str(tmp_path / "out"))
    assert report["unique_orders"] == orders
    assert report["raw_events"] == report["silver_events"] == len(lines)
    assert report["delivered_orders"] == sum(o % 4 == 3 for o in range(orders))
    assert read(spark, tmp_path / "out", "daily").count() == 1


def test_total_bronze_order(spark, finished, tmp_path):
    source, report, _ = finished
    config = StreamConfig(bronze_order="total")
    assert run(spark, source, str(tmp_path / "out"), config) == report
    stored = [r["_source_row"] for r in part_rows(tmp_path / "out" / LAYOUT["bronze"])]
    assert stored == sorted(stored)


def test_missing_input_fails_at_once(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        run(spark, str(tmp_path / "nowhere"), str(tmp_path / "out"))


def test_output_names_are_documented():
    readme = (ROOT / "README.md").read_text()
    assert all(path in readme for path in LAYOUT.values())


def test_further_field_reaches_every_layer_and_nothing_staged_stays(spark, tmp_path):
    config = StreamConfig(fields=(*StreamConfig().fields, "channel"))
    lines = [event("e1", channel="app"), event("e1", channel="app"), event(None, channel="web")]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/x.jsonl").write_text("".join(json.dumps(line) + "\n" for line in lines))
    before = staged_folders(spark)
    run(spark, str(tmp_path / "in"), str(tmp_path / "out"), config)
    with pytest.raises(ZeroDivisionError), workspace(spark, "fails"):
        stage(spark.range(3), scratch_path(spark, "rows"))
        raise ZeroDivisionError
    assert staged_folders(spark) == before
    for name, value in (("silver", "app"), ("quarantine", "web")):
        assert [r["channel"] for r in read(spark, tmp_path / "out", name).collect()] == [value]
