"""Landing: raw lines to lossless Bronze rows."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventstrata.config import DEFAULT, StreamConfig
from eventstrata.functions.json_text import with_json_fields
from eventstrata.functions.text import is_blank, strip_carriage_returns
from eventstrata.session import scratch_path, stage

BRONZE_KEYS = ("_source_file", "_source_row")


def relative_file(spark: SparkSession, path: str) -> Column:
    """The current file's path below ``path``: the bare name for files that lie in it directly.

    Where ``path`` is a pattern, below its last folder without one; where it is a file, its name.
    The mount point stays out of the data, and files of one name in several folders differ.
    """
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(jvm_path)
    parts = [part for part in whole.toUri().getPath().split("/") if part]
    fixed = next((i for i, part in enumerate(parts) if set(part) & set("*?[{")), len(parts))
    names = F.split(F.regexp_replace("_metadata.file_path", "^[^:/]+:(//[^/]*)?/", ""), "/")
    below = F.slice(names, F.lit(fixed + 1), F.greatest(F.size(names) - fixed, F.lit(0)))
    return F.when(F.size(below) > 0, F.array_join(below, "/")).otherwise(F.col("_metadata.file_name"))


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every physical line as text, with the file and block it came from.

    The separator is pinned: by default a lone carriage return would also end a line.
    """
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            "value",
            relative_file(spark, path).alias("_source_file"),
            F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.file_block_start").alias("_block"),
        )
    )


def payload_lines(lines: DataFrame) -> DataFrame:
    """Drop carriage returns at the ends, then blank lines; the only silent drop."""
    rest = [c for c in lines.columns if c != "value"]
    cleaned = lines.select(strip_carriage_returns(F.col("value")).alias("_raw_payload"), *rest)
    return cleaned.where(~is_blank(F.col("_raw_payload")))


class Offsets(NamedTuple):
    """Where the blocks of the input lie: a small table, and the totals over all blocks."""

    table: DataFrame
    blocks: int
    size: int


def _block_offsets(placed: DataFrame) -> Offsets:
    """Per block its first and last row, the lines of its file and the bytes of all blocks before it."""
    spark = placed.sparkSession
    counted = placed.groupBy("_path", "_block").agg(
        F.first("_source_file").alias("_source_file"),
        F.min("_at").alias("_first"),
        F.max("_at").alias("_last"),
        F.count("*").alias("_lines"),
        F.sum(F.octet_length("_raw_payload")).alias("_bytes"),
    )
    earlier = (W.unboundedPreceding, -1)
    in_file = W.partitionBy("_path").orderBy("_block").rowsBetween(*earlier)
    # A row per block of the input, so one task may add them up.
    overall = W.orderBy("_source_file", "_path", "_block").rowsBetween(*earlier)
    offsets = counted.select(
        F.xxhash64("_path", "_block").alias("_key"),
        "_first",
        "_last",
        "_bytes",
        F.coalesce(F.sum("_lines").over(in_file), F.lit(0)).alias("_offset"),
        F.coalesce(F.sum("_bytes").over(overall), F.lit(0)).alias("_before"),
    )
    seen = Observation()
    offsets = offsets.observe(seen, F.count("*").alias("blocks"), F.sum("_bytes").alias("size"))
    staged = stage(offsets, scratch_path(spark, "line-offsets"))
    return Offsets(staged, seen.get["blocks"], seen.get["size"] or 0)


def _numbered(payloads: DataFrame, config: StreamConfig) -> tuple[DataFrame, Offsets]:
    placed = payloads.withColumn("_at", F.monotonically_increasing_id())
    offsets = _block_offsets(placed)
    table = F.broadcast(offsets.table) if offsets.blocks <= config.max_broadcast_blocks else offsets.table
    in_block = F.col("_at").between(F.col("_first"), F.col("_last"))
    ordinal = F.col("_offset") + F.col("_at") - F.col("_first") + 1
    misplaced = F.raise_error(F.lit("input was split differently between two scans"))
    joined = placed.withColumn("_key", F.xxhash64("_path", "_block")).join(table, "_key", "left")
    row = F.when(in_block, ordinal).otherwise(misplaced.cast("long"))
    return joined.withColumn("_source_row", row), offsets


PLACES = ("_key", "_at", "_first", "_last", "_bytes", "_offset", "_before")


def number_lines(payloads: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    """Add ``_source_row``: the 1-based ordinal among a file's non-blank lines.

    No global window over lines: a first scan counts the lines of every block, a running
    total per file over those counts gives each block its offset, and the second scan adds
    the position inside the block. Only block offsets are joined, as six numbers per block
    and by broadcast up to ``max_broadcast_blocks``. Both scans must cut the files alike; a
    row that falls outside its block's range, also by a clash of two blocks' hashes, stops
    the job instead of getting a wrong ordinal.
    """
    return _numbered(payloads, config)[0].drop(*PLACES)


def order_lines(payloads: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    """Numbered lines in total order: partition i holds the lines before those of i + 1.

    The block offsets already say how many bytes lie before a line, so they give its
    partition directly: nothing is sampled, the lines are scanned once more and shuffled
    once, and partitions are of one size in bytes whatever the line lengths.
    """
    spark = payloads.sparkSession
    numbered, offsets = _numbered(payloads, config)
    size = max(offsets.size, 1)
    few = min(spark.sparkContext.defaultParallelism, -(-size // config.min_partition_bytes))
    parts = max(-(-size // config.partition_bytes), few)
    inside = (F.col("_at") - F.col("_first")) / (F.col("_last") - F.col("_first") + 1)
    share = (F.col("_before") + F.col("_bytes") * inside) / size
    part = F.least(F.floor(share * parts), F.lit(parts - 1)).cast("int")
    dealt = numbered.withColumn("_part", part).drop(*PLACES).repartitionById(parts, "_part").drop("_part")
    return dealt.sortWithinPartitions(*BRONZE_KEYS)


def land_rows(payloads: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    """Bronze from rows that already carry ``_source_file``, ``_source_row``, ``_raw_payload``."""
    return with_json_fields(
        payloads.select("_source_row", "_source_file", "_raw_payload"),
        "_raw_payload",
        config.fields,
    )


def land_files(spark: SparkSession, path: str, config: StreamConfig = DEFAULT) -> DataFrame:
    """Bronze from text files. A missing path fails at once with Spark's own error.

    In total order by file and line (``bronze_order="total"``), the payload being parsed
    behind the shuffle, or as scanned.
    """
    numbering = order_lines if config.bronze_order == "total" else number_lines
    return land_rows(numbering(payload_lines(scan_lines(spark, path)), config), config)
