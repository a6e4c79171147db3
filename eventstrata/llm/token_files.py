"""Flat token files: written by Spark, counted by a separator scan over blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventstrata.llm.common import text_bytes
from eventstrata.llm.tokens import load_encoder

# Bytes per id: the text writer's encoding that writes one character as such an id.
ENCODINGS = {2: "UTF-16LE", 4: "UTF-32LE"}
BLOCK_BYTES = 1 << 20


def write_token_files(
    documents: DataFrame, path: str, tokenizer: str, end_id: int, id_bytes: int = 2, rows_per_file: int = 100_000
) -> None:
    """Write the ids of all texts as flat little-endian files, each text followed by end_id.

    The files hold nothing but ids: no lengths, no index. The writer puts the separator
    between rows as text writers put line ends: a character whose code is end_id. Null and
    empty texts are a lone separator. Special tokens' strings are ordinary text, so no id
    inside a document equals end_id. The shuffle-free order is that of the input.
    """
    if 0xD800 <= end_id <= 0xDFFF or not 0 <= end_id < min(1 << 8 * id_bytes, 0x110000):
        raise ValueError(f"end_id {end_id} is no character of {ENCODINGS[id_bytes]}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load_encoder(tokenizer, special=False)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                texts = text_bytes(batch.column("text").slice(at, 256))
                rows = [
                    np.array(encode((t or b"").decode("utf-8", "replace")), dtype=f"<u{id_bytes}").tobytes()
                    for t in texts
                ]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["ids"])

    ids = documents.select("text").mapInArrow(run, "ids binary").select(F.col("ids").cast("string").alias("value"))
    (
        ids.write.option("encoding", ENCODINGS[id_bytes])
        .option("lineSep", chr(end_id))
        .option("maxRecordsPerFile", rows_per_file)
        .text(path)
    )


def token_blocks(spark: SparkSession, path: str, id_bytes: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, block, bytes): the files cut into blocks of whole ids. Empty files have none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0")
    broken = F.raise_error(F.concat(F.lit("not a whole number of ids: "), F.col("path"))).cast("long")
    last = F.when(F.col("length") % id_bytes == 0, F.floor((F.col("length") - 1) / block_bytes)).otherwise(broken)
    cut = F.transform(
        F.sequence(F.lit(0).cast("long"), last),
        lambda i: F.substring(F.col("content"), (i * block_bytes + 1).cast("int"), F.lit(block_bytes)),
    )
    name = F.element_at(F.split("path", "/"), -1).alias("file")
    return files.select(name, F.posexplode(cut).alias("block", "bytes"))


def _scan(end_id: int, id_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, size = [], []
            for raw in batch.column("bytes"):
                ids = np.frombuffer(raw.as_buffer(), dtype=f"<u{id_bytes}")
                ends.append(np.flatnonzero(ids == end_id).astype(np.int32))
                size.append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("block"), pa.array(size, pa.int32()), pa.array(ends, pa.list_(pa.int32()))],
                names=["file", "block", "size", "ends"],
            )

    return run


def count_tokens(blocks: DataFrame, end_id: int, id_bytes: int = 2) -> DataFrame:
    """One row per document of the files: file, ordinal, start, n_tokens, terminated.

    Ordinals count from 0 inside a file; start is the place of the first id; n_tokens
    leaves the separator out. Each block is searched for separators on its own; running
    sums of the blocks' ids and separators, and the last separator before a block, then
    place a block's documents, so one that spans blocks is stitched. Ids after a file's
    last separator are a document that is not terminated. Blocks without ids add nothing;
    no block, no row.
    """
    found = blocks.select("file", "block", "bytes").mapInArrow(
        _scan(end_id, id_bytes), "file string, block int, size int, ends array<int>"
    )
    by_block = W.partitionBy("file").orderBy("block")
    earlier = by_block.rowsBetween(W.unboundedPreceding, -1)

    def before(value: Column, default: int = 0) -> Column:
        return F.coalesce(value, F.lit(default)).cast("long")

    offset = before(F.sum("size").over(earlier))
    placed = found.select("file", "block", "size", "ends", offset.alias("offset"))
    placed = placed.withColumn("last", F.when(F.size("ends") > 0, F.element_at("ends", -1) + F.col("offset")))
    placed = placed.select(
        "*",
        before(F.max("last").over(earlier), -1).alias("previous"),
        before(F.sum(F.size("ends")).over(earlier)).alias("documents"),
        F.lead("block").over(by_block).isNull().alias("is_last"),
    )
    stop = F.col("offset") + F.col("size")
    ends = F.transform("ends", lambda e: e + F.col("offset"))
    rest = F.when(F.col("is_last") & (F.coalesce("last", "previous") < stop - 1), F.array(stop))
    starts = F.concat(F.array(F.col("previous")), ends)
    stops = F.concat(ends, F.coalesce(rest, F.array().cast("array<long>")))
    pairs = F.filter(F.arrays_zip(starts.alias("p"), stops.alias("e")), lambda x: x["e"].isNotNull())
    rows = placed.select("file", "documents", "last", "previous", stop.alias("stop"), F.posexplode(pairs).alias("i", "x"))
    return rows.select(
        "file",
        (F.col("documents") + F.col("i")).alias("ordinal"),
        (F.col("x.p") + 1).alias("start"),
        (F.col("x.e") - F.col("x.p") - 1).alias("n_tokens"),
        (F.col("x.e") < F.col("stop")).alias("terminated"),
    )
