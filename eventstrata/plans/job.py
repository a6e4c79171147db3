"""The whole run: land, validate, deduplicate, gate, publish."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from eventstrata.config import DEFAULT, StreamConfig
from eventstrata.operators import quality
from eventstrata.operators.cohort import DAILY_KEYS, daily_metrics
from eventstrata.operators.dedup import SILVER_KEYS, dedup_input, silver_columns, silver_with_counts
from eventstrata.operators.lifecycle import ORDER_KEYS, reconstruct
from eventstrata.operators.validate import rejected, slim, valid, validate
from eventstrata.session import configure, in_parallel, reread, scratch_path, stage, workspace
from eventstrata.sinks.generations import Generations
from eventstrata.sinks.tables import (
    write_ordered,
    write_report,
    write_scan_order,
    write_small_ordered,
)
from eventstrata.sources.lines import BRONZE_KEYS, land_files

REPORT_SCHEMA = T.StructType(
    [
        T.StructField(
            name,
            {
                "rejected_by_reason": T.MapType(T.StringType(), T.LongType()),
                "late_event_rate": T.DoubleType(),
            }.get(name, T.LongType()),
        )
        for name in quality.REPORT_FIELDS
    ]
)


def run(
    spark: SparkSession, input_path: str, output_dir: str, config: StreamConfig = DEFAULT
) -> dict[str, Any]:
    """Build every table from the input and return the report.

    Each layer is written once and read back by the next, which keeps every stage
    restartable from files. Bronze and the quarantine are evidence and always written;
    Silver, Gold and the report replace their predecessors only after the counts add up:
    the rows of the written Bronze against those of the written quarantine and Silver, so
    that a row lost or multiplied anywhere after landing stops the run. Staged tables are
    removed at the end, also of a run that fails.

    With ``config.publish="generations"`` the layers are written to folders of their own and
    become visible together at the end (``Generations``); a run that fails, wherever, leaves
    all readers on the layers of the run before.
    """
    configure(spark)
    with workspace(spark, "run"):
        if config.publish == "replace":
            return _run(spark, input_path, output_dir, config)
        published = Generations(spark, output_dir)
        folder = published.begin()
        report = _run(spark, input_path, folder, config)
        published.publish(folder, config.layout)
        return report


def _run(
    spark: SparkSession, input_path: str, output_dir: str, config: StreamConfig
) -> dict[str, Any]:
    paths = {name: f"{output_dir.rstrip('/')}/{rel}" for name, rel in config.layout.items()}
    codec = config.compression

    bronze = land_files(spark, input_path, config)
    write_scan_order(bronze, paths["bronze"], codec)
    bronze = reread(bronze, paths["bronze"])

    rows = stage(slim(validate(bronze, config)), scratch_path(spark, "validated"))
    deduplicated = silver_with_counts(dedup_input(valid(rows), config), config)
    quarantine = rejected(rows, config)
    raw, _, silver = in_parallel(
        spark,
        lambda: bronze.count(),
        lambda: write_ordered(quarantine, paths["quarantine"], BRONZE_KEYS, codec),
        lambda: stage(deduplicated, scratch_path(spark, "silver")),
    )
    refused, counts = in_parallel(
        spark,
        lambda: quality.quarantine_counts(reread(quarantine, paths["quarantine"])).first().asDict(),
        lambda: quality.silver_counts(silver).first().asDict(),
    )
    counts = {"raw_events": raw, **refused, **counts}
    quality.assert_reconciles(counts)

    silver = silver.select(*silver_columns(config))
    write_ordered(silver, paths["silver"], SILVER_KEYS, codec)
    # Staged, so that choosing the key ranges does not aggregate Silver once more.
    orders = stage(reconstruct(reread(silver, paths["silver"]), config), scratch_path(spark, "orders"))
    write_ordered(orders, paths["orders"], ORDER_KEYS, codec)
    orders = reread(orders, paths["orders"])
    _, finished = in_parallel(
        spark,
        lambda: write_small_ordered(daily_metrics(orders, config), paths["daily"], DAILY_KEYS, codec),
        lambda: quality.order_counts(orders, config).first().asDict(),
    )

    counts.update(finished)
    counts["rejected_by_reason"] = quality.reject_counts(refused)
    report = {name: counts[name] for name in quality.REPORT_FIELDS}
    write_report(spark.createDataFrame([report], REPORT_SCHEMA), paths["report"])
    return report
