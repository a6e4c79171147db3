"""Structured Streaming variants of landing, validation, deduplication and late routing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventstrata.config import DEFAULT, StreamConfig
from eventstrata.functions.times import seconds_between
from eventstrata.operators.dedup import dedup_input, drop_exact, drop_semantic
from eventstrata.operators.validate import valid, validate
from eventstrata.session import reread, scratch_path, stage, workspace
from eventstrata.sinks.tables import write_scan_order
from eventstrata.sources.lines import land_rows, payload_lines, relative_file
from eventstrata.streaming.batches import BatchTable, batch_folder

# A backlog is caught up in at most so many micro-batches.
MOST_BATCHES = 8


def files_to_catch_up(spark: SparkSession, path: str, least: int) -> int:
    """Files per micro-batch for a folder whose files all wait already: ``least``, or more for a long backlog.

    A micro-batch costs a fixed time and reads the stored index within the horizon again, so
    with a fixed number of files the cost of a backlog grows with the square of its length.
    In at most ``MOST_BATCHES`` parts every part grows with the backlog, and both costs are in
    proportion to it. Each part is an ordinary Spark job, which may spill.
    """
    waiting = len(spark.read.text(path).inputFiles())
    return max(least, -(-waiting // MOST_BATCHES))


def stream_bronze(
    spark: SparkSession,
    path: str,
    config: StreamConfig = DEFAULT,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Bronze as a stream of new files. Line ordinals need a second scan and stay NULL."""
    reader = spark.readStream.option("lineSep", "\n")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    lines = reader.text(path).select("value", relative_file(spark, path).alias("_source_file"))
    numbered = payload_lines(lines).withColumn("_source_row", F.lit(None).cast("long"))
    return land_rows(numbered, config)


def stream_validated(bronze: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    """The batch validation: it is row-local apart from the broadcast vocabulary."""
    return validate(bronze, config)


def append_to(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def each_batch(
    df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _newest_date(rows: DataFrame, path: str, batch_id: int) -> dt.date | None:
    """The newest event date up to this batch; each batch stores it for the next one.

    An event moves it no further than its own arrival, so a clock that runs ahead cannot
    put all later events behind the horizon.
    """
    newest = rows.agg(F.max(F.to_date(F.least("event_time", "ingested_at"))).alias("newest"))
    if batch_id:
        before = reread(newest, batch_folder(path, batch_id - 1))
        newest = newest.unionByName(before).agg(F.max("newest").alias("newest"))
    return stage(newest, batch_folder(path, batch_id)).first()[0]


def deduplicate_batches(
    silver_path: str,
    seen_path: str,
    expired_path: str,
    horizon_days: int,
    config: StreamConfig = DEFAULT,
    compact_every: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """Micro-batch handler: both duplicate stages against a recent index.

    Inside the batch the stages are the batch aggregates, which combine before they
    shuffle, so a redelivery storm on one id stays cheap. Against earlier batches they are
    anti-joins with the ids and business keys stored within the horizon; both stored sides
    are unique per key. Rows behind the horizon go to ``expired_path`` for a restatement
    instead of being dropped. Between batches the first processed copy stays, not the
    earliest ingested one: the business keys equal the batch result, the surviving ids may
    not.

    Stored tables have date folders, so a batch reads those within the horizon only, and
    the newest date is kept beside the index (``seen_path`` and "-newest"): what a batch
    reads is bounded by the horizon, not by the age of the stream. Batch ids follow each other.
    """

    def handle(rows: DataFrame, batch_id: int) -> None:
        with workspace(rows.sparkSession, "micro-batch"):
            deduplicate(stage(rows, scratch_path(rows.sparkSession, "rows")), batch_id)

    def deduplicate(rows: DataFrame, batch_id: int) -> None:
        unseen = drop_exact(rows, config).withColumn("event_date", F.to_date("event_time"))
        index = BatchTable(rows.sparkSession, seen_path, unseen.schema, compact_every)
        index.compact(batch_id)
        seen = index.before(batch_id)
        newest = _newest_date(rows, f"{seen_path}-newest", batch_id)
        earliest = dt.date.min + dt.timedelta(horizon_days)
        cutoff = F.lit(max(newest or earliest, earliest) - dt.timedelta(horizon_days))

        behind = F.to_date("event_time") < cutoff
        write_scan_order(rows.where(behind), batch_folder(expired_path, batch_id))
        ids = list(config.exact_key)
        recent = seen.where(F.col("event_date") >= cutoff).select(*ids)
        unseen = unseen.where(F.col("event_date") >= cutoff).join(recent, ids, "left_anti")
        unseen = index.write(unseen, batch_id)

        survivors = drop_semantic(unseen, config)
        silver = BatchTable(rows.sparkSession, silver_path, survivors.schema, compact_every)
        silver.compact(batch_id)
        known = silver.before(batch_id).where(F.col("event_date") >= cutoff).select(*config.semantic_key)
        new, known = survivors.alias("new"), known.alias("known")
        same = [
            F.col(f"new.{part}").eqNullSafe(F.col(f"known.{part}"))
            for part in config.semantic_key
        ]
        fresh = new.join(known, reduce(Column.__and__, same), "left_anti")
        silver.write(fresh, batch_id)

    return handle


def route_by_lateness(
    on_time_path: str, late_path: str, allowed_seconds: int
) -> Callable[[DataFrame, int], None]:
    """Micro-batch handler with a side output for rows later than the allowed bound."""

    def handle(rows: DataFrame, batch_id: int) -> None:
        lag = seconds_between(F.col("event_time"), F.col("ingested_at"))
        timed = rows.withColumn("lateness_seconds", lag)
        too_late = F.col("lateness_seconds") > allowed_seconds
        with workspace(rows.sparkSession, "micro-batch"):
            timed = stage(timed, scratch_path(rows.sparkSession, "rows"))
            write_scan_order(timed.where(~too_late), batch_folder(on_time_path, batch_id))
            write_scan_order(timed.where(too_late), batch_folder(late_path, batch_id))

    return handle


def stream_valid(
    spark: SparkSession,
    path: str,
    config: StreamConfig = DEFAULT,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Typed valid rows of new files, in the form both handlers take."""
    bronze = stream_bronze(spark, path, config, files_per_trigger)
    return dedup_input(valid(stream_validated(bronze, config)), config)
