"""Small builders for hand-written rows."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import functions as F

from eventstrata.operators.dedup import dedup_input, silver_with_counts
from eventstrata.operators.validate import valid, validate
from eventstrata.session import scratch_path, scratch_root, stage
from eventstrata.sources.lines import land_rows

ROOT = Path(__file__).resolve().parents[1]
TESTDATA = os.environ.get("EVENTSTRATA_TESTDATA", "/root/testdata")
DAY = "2026-09-03T"


def event(event_id, event_type="ORDER_CREATED", at="10:00:00Z", **other):
    row = {
        "event_id": event_id,
        "order_id": "o1",
        "event_type": event_type,
        "event_time": DAY + at,
        "ingested_at": DAY + at,
        "city": None,
        "rider_id": None,
        "supplier_id": None,
    }
    return {**row, **other}


def bronze(spark, *lines):
    texts = [line if isinstance(line, str) else json.dumps(line) for line in lines]
    rows = [(i + 1, "f.jsonl", text) for i, text in enumerate(texts)]
    schema = "_source_row long, _source_file string, _raw_payload string"
    return land_rows(spark.createDataFrame(rows, schema))


def silver(spark, *lines):
    typed = dedup_input(valid(validate(bronze(spark, *lines))))
    return stage(silver_with_counts(typed), scratch_path(spark, "silver"))


def column(df, name, order):
    return [r[name] for r in df.orderBy(order).select(F.col(name)).collect()]


def staged_folders(spark):
    root = Path(scratch_root(spark).removeprefix("file:"), "eventstrata")
    return {p.name for p in root.glob("*")}
