"""Streaming deduplication on watermark state, behind a combine per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventstrata.config import DEFAULT, StreamConfig
from eventstrata.operators.dedup import drop_exact
from eventstrata.sinks.tables import write_scan_order
from eventstrata.streaming.batches import batch_folder

CLOCK = "_clock"


def combine_batches(path: str, config: StreamConfig = DEFAULT) -> Callable[[DataFrame, int], None]:
    """Micro-batch handler: one row per event id of the batch, stored for ``unique_in_state``.

    The state operator shuffles every row to the task of its key. Combined here first, a
    redelivery storm on one id reaches it as one row per micro-batch instead of one per copy.
    """

    def handle(rows: DataFrame, batch_id: int) -> None:
        write_scan_order(drop_exact(rows, config), batch_folder(path, batch_id))

    return handle


def unique_in_state(
    spark: SparkSession,
    path: str,
    schema: StructType,
    horizon_days: int,
    config: StreamConfig = DEFAULT,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """First processed row per event id, then per business key, as a stream.

    ``path`` holds what ``combine_batches`` stored. Keys stay in the state store until the
    watermark is ``horizon_days`` past them, so state follows the horizon and not the age of
    the stream; rows behind the watermark are dropped. An event's clock is its time, but not
    later than its arrival: a producer's clock that runs ahead moves no watermark. Business
    keys equal the batch result as long as copies arrive within the horizon; which of a
    fact's ids survives may differ. NULL keys equal each other. Set the session's state store
    provider to RocksDB where the keys of a horizon exceed the executors' memory.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    clock = F.least("event_time", "ingested_at").cast("timestamp")
    timed = reader.parquet(f"{path}/batch_id=*").withColumn(CLOCK, clock)
    return (
        timed.withWatermark(CLOCK, f"{horizon_days} days")
        .dropDuplicatesWithinWatermark(list(config.exact_key))
        .dropDuplicatesWithinWatermark(list(config.semantic_key))
        .drop(CLOCK)
    )
