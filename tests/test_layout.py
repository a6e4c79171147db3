"""Lineage, partition ids of sorted Bronze, and checks on how tables lie in their files."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from eventstrata.config import StreamConfig
from eventstrata.operators.layout import physical_order, with_position
from eventstrata.session import reread, scratch_path
from eventstrata.sinks.tables import write_ordered, write_scan_order
from eventstrata.sources.lines import BRONZE_KEYS, land_files, scan_lines


@pytest.fixture
def nested(tmp_path):
    """Files of one name in several folders, of very different line lengths."""
    for folder in ("", "a", "a/b", "c d"):
        (tmp_path / folder).mkdir(exist_ok=True, parents=True)
        for n in range(3):
            long = "x" * (5000 if n == 1 else 1)
            lines = [f'{{"event_id":"{folder}-{n}-{i}{long}"}}' for i in range(50 + n)]
            (tmp_path / folder / f"part-{n}.txt").write_text("\n".join(lines))
    return tmp_path


@pytest.fixture
def small_blocks(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "100"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_lineage_is_unique_over_folders(spark, nested, small_blocks):
    rows = land_files(spark, str(nested), StreamConfig()).select(*BRONZE_KEYS).collect()
    top = {(f"part-{n}.txt", i) for n in range(3) for i in range(1, 51 + n)}
    assert set(map(tuple, rows)) == top and len(rows) == len(top)
    deep = land_files(spark, f"{nested}/{{a,a/b}}").select(*BRONZE_KEYS).collect()
    assert len(set(map(tuple, deep))) == len(deep) == 2 * len(top)
    assert {r["_source_file"] for r in deep} == {f"{d}/part-{n}.txt" for d in ("a", "a/b") for n in range(3)}


@pytest.mark.parametrize("path, name", [("", "part-0.txt"), ("part-0.txt", "part-0.txt"), ("part-[0]*", "part-0.txt")])
def test_names_are_relative_to_the_input(spark, nested, path, name):
    names = {r[0] for r in scan_lines(spark, f"{nested}/{path}").select("_source_file").distinct().collect()}
    assert name in names and all("/" not in n for n in names)


def test_partition_ids_give_total_order_without_sampling(spark, nested, small_blocks):
    config = StreamConfig(partition_bytes=40_000, min_partition_bytes=1000)
    landed = land_files(spark, f"{nested}/*/", config)
    text = landed._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in text and "Exchange" in text
    assert len(re.findall(r"Scan text", text)) == 1
    # The payload is shuffled, its parsed fields are not.
    assert "get_json_object" not in text.split("Exchange")[1] and "_is_valid_json" not in text.split("Exchange")[1]
    path = scratch_path(spark, "sorted-bronze")
    write_scan_order(landed, path)
    stored = reread(landed, path)
    assert physical_order(stored, BRONZE_KEYS).first().asDict() == {
        "rows": 3 * 153,
        "unordered_rows": 0,
        "unordered_parts": 0,
    }
    sizes = stored.groupBy(F.col("_metadata.file_name")).agg(F.sum(F.length("_raw_payload")).alias("n"))
    sizes = [r["n"] for r in sizes.collect()]
    assert len(sizes) > 8 and max(sizes) < 40_000 + 5100


def test_shuffled_and_misnamed_tables_are_found(spark):
    rows = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    good, shuffled, descending = (scratch_path(spark, n) for n in ("good", "shuffled", "descending"))
    write_ordered(rows, good, ["k"])
    write_scan_order(rows.repartition(4, "v"), shuffled)
    write_scan_order(rows.repartitionByRange(4, F.desc("k")).sortWithinPartitions("k"), descending)
    read = lambda path: spark.read.schema(rows.schema).parquet(path)
    found = [physical_order(read(p), ["k"]).first().asDict() for p in (good, shuffled, descending)]
    assert found[0] == {"rows": 1000, "unordered_rows": 0, "unordered_parts": 0}
    assert found[1]["unordered_rows"] + found[1]["unordered_parts"] > 0
    assert found[2]["unordered_rows"] == 0 and found[2]["unordered_parts"] == 3
    assert [r["k"] for r in with_position(read(good)).orderBy("position").collect()] == list(range(1000))
    assert physical_order(read(good).where("false"), ["k"]).first().asDict() == {
        "rows": 0,
        "unordered_rows": 0,
        "unordered_parts": 0,
    }
