"""The event vocabulary as a reference table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventstrata.config import DEFAULT, StreamConfig


def vocabulary(spark: SparkSession, config: StreamConfig = DEFAULT) -> DataFrame:
    """One row per event type. The config guarantees unique names and a bounded size."""
    rows, values = [], {}
    for i, t in enumerate(config.event_types):
        rows.append(f"(:name{i}, int(:rank{i}), :terminal{i})")
        values |= {f"name{i}": t.name, f"rank{i}": t.rank, f"terminal{i}": t.terminal}
    columns = "event_type, lifecycle_rank, is_terminal"
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({columns})", values)
