"""A messy delivery stream derived from the ``events`` table, row by row.

Every event becomes one JSON line; fixed remainders of its id decide which lines are
broken, blanked, repeated or re-sent under a new id. ``FIXTURES.md`` lists the classes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventstrata.config import PAYLOAD_FIELDS
from eventstrata.session import scratch_path, spread

# Lines of this many consecutive events share one landing file.
EVENTS_PER_FILE = 4096


def _every(n: int) -> Column:
    return F.col("k") % n == 0


def _padded(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def _utc_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What really happened: one clean, typed delivery event per row of ``events``."""
    source = spread(spark.read.parquet(f"{sf_dir}/events.parquet"), "event_id")
    source = source.withColumnRenamed("event_id", "k")
    kind, user, k = F.col("event_type"), F.col("user_id"), F.col("k")
    error_type = (
        F.when(k % 3 == 0, "CANCELLED").when(k % 3 == 1, "STARTED_PICKUP").otherwise("TELEPORTED")
    )
    delivery_type = (
        F.when(kind == "signup", "ORDER_CREATED")
        .when(kind == "view", "RIDER_ALLOCATED")
        .when(kind == "click", "RIDER_ACCEPTED")
        .when(kind == "purchase", "DELIVERED")
        .otherwise(error_type)
    )
    delay = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.floor("value"))
    return source.select(
        "k",
        _padded("evt_", k, 9).alias("event_id"),
        _padded("ord_", F.floor(k / 6), 7).alias("order_id"),
        delivery_type.alias("event_type"),
        F.col("ts").alias("event_time"),
        (F.col("ts") + delay).alias("ingested_at"),
        F.when(user % 11 != 0, F.concat(F.lit("city_"), user % 5)).alias("city"),
        F.when(kind != "signup", _padded("rider_", user, 6)).alias("rider_id"),
        F.concat(F.lit("supplier_0"), user % 8 + 1).alias("supplier_id"),
    )


def _line(event_id: Column) -> Column:
    """The event as compact JSON text under the given id."""
    values = {c: F.col(c) for c in PAYLOAD_FIELDS}
    values["event_id"] = event_id
    values["order_id"] = F.when(~_every(103), F.col("order_id"))
    values["event_time"] = F.when(_every(109), "not-a-timestamp").otherwise(
        _utc_text(F.col("event_time"))
    )
    values["ingested_at"] = F.when(~_every(113), _utc_text(F.col("ingested_at")))
    parts = [
        F.concat(
            F.lit(f'"{name}":'),
            F.coalesce(F.concat(F.lit('"'), value, F.lit('"')), F.lit("null")),
        )
        for name, value in values.items()
    ]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _lines(number: str, *choices: tuple[Column, Column]) -> Column:
    """One numbered text row per choice whose condition holds."""
    numbered = [
        F.when(wanted, F.struct(F.lit(i).alias(number), text.alias("value")))
        for i, (wanted, text) in enumerate(choices)
    ]
    return F.inline(F.array_compact(F.array(*numbered)))


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream as rows with lineage, ready to land."""
    sent_id = F.when(_every(107), F.lit("  ")).otherwise(F.col("event_id"))
    whole = _line(sent_id)
    broken = F.substring(whole, F.lit(1), F.length(whole) - 1)
    resent = _line(F.concat(F.lit("dup_"), F.col("event_id")))
    lines = facts(spark, sf_dir).select(
        "k",
        _lines(
            "copy",
            (F.lit(True), F.when(_every(101), broken).otherwise(whole)),
            (_every(29), whole),
            (_every(50), resent),
        ),
    )
    shard = F.floor(F.col("k") / EVENTS_PER_FILE)
    return lines.select(
        (F.col("k") * 3 + F.col("copy") + 1).alias("_source_row"),
        F.concat(F.lit("shard="), shard).alias("_source_file"),
        F.col("value").alias("_raw_payload"),
        shard.alias("shard"),
    )


def physical_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream as a producer wrote it: some Windows line ends, some blank lines."""
    line = F.col("_source_row")
    k = F.floor((line - 1) / 3)
    first = (line - 1) % 3 == 0
    text = F.when(k % 7 == 0, F.concat("_raw_payload", F.lit("\r"))).otherwise(
        F.col("_raw_payload")
    )
    blanks = {37: "", 41: "  ", 43: "\u00a0", 47: "\r"}
    return payloads(spark, sf_dir).select(
        "shard",
        line.alias("line"),
        _lines(
            "slot",
            (F.lit(True), text),
            *[(first & (k % n == 0), F.lit(blank)) for n, blank in blanks.items()],
        ),
    )


def write_landing_files(spark: SparkSession, sf_dir: str) -> str:
    """Write the physical lines as text, one file per shard, and return the folder."""
    path = scratch_path(spark, "landing")
    order = ("shard", "line", "slot")
    (
        physical_lines(spark, sf_dir)
        .repartition("shard")
        .sortWithinPartitions(*order)
        .select("shard", "value")
        .write.partitionBy("shard")
        .option("lineSep", "\n")
        .text(path)
    )
    return path
