"""SimHash near-duplicates: fingerprints, Hamming links, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventstrata.llm.common import group_starts, numbers, text_bytes, whole_groups
from eventstrata.llm.graph import components
from eventstrata.llm.gray_index import GrayIndex, gray_rank, roots, unite
from eventstrata.session import scratch_path, stage

SEED = 42
BITS = 64
SLICE = 1 << 16
# Fingerprints of one band value that a task indexes at once; beyond, they are dealt to tiles.
TILE = 4096


def fingerprint(text: bytes | None, words_per_shingle: int) -> int:
    """The fingerprint of one text as a signed 64-bit number; zero without a word."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(length + 1) - 1
    start = end - length
    width = min(words_per_shingle, len(words))
    total = len(words) - width + 1
    first, last = start[:total].tolist(), end[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    bits = np.zeros(BITS, dtype=np.int64)
    for at in range(0, total, SLICE):
        hashes = [digest(joined[s:e], SEED) for s, e in zip(first[at : at + SLICE], last[at : at + SLICE])]
        raw = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > total, bitorder="little").view("<i8")[0])


def simhash(text: Column, words_per_shingle: int) -> Column:
    """Fingerprint column of a text column, as a signed long. Null and wordless texts: zero."""

    @F.arrow_udf("long")
    def compute(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t, words_per_shingle) for t in text_bytes(texts)], pa.int64())

    return compute(text)


def hex_fingerprint(code: Column) -> Column:
    return F.lower(F.lpad(F.hex(code), 16, "0"))


def _bands(code: Column, count: int) -> Column:
    """Band values: codes within count - 1 bits agree in at least one of them."""
    width = BITS // count
    parts = []
    for b in range(count):
        bits = width if b < count - 1 else BITS - width * (count - 1)
        part = F.shiftrightunsigned(code, b * width).bitwiseAND(F.lit((1 << bits) - 1 if bits < 64 else -1))
        parts.append(F.struct(F.lit(b).alias("band"), part.alias("value")))
    return F.array(*parts)


def _tiled(codes: DataFrame, radius: int) -> DataFrame:
    """Each code once per tile in which partners may be: its band values, large ones split.

    A band value of n codes is cut into salts of about TILE codes; each pair of salts is a
    tile, so a value that holds a third of all codes is many bounded tasks, none left out.
    """
    keyed = codes.select("code", F.inline(_bands(F.col("code"), radius + 1)))
    sizes = keyed.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1")
    sizes = sizes.select("band", "value", F.ceil(F.col("n") / TILE).cast("int").alias("salts"))
    dealt = keyed.join(sizes, ["band", "value"]).withColumn(
        "salt", F.pmod(F.xxhash64("code", "band"), F.col("salts")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("other")
    return dealt.select("code", "band", "value", "salt", other).select(
        "code",
        "band",
        "value",
        F.least("salt", "other").alias("low"),
        F.greatest("salt", "other").alias("high"),
    )


TILE_KEYS = ["band", "value", "low", "high"]


def _links(radius: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, TILE_KEYS):
            codes = numbers(rows, "code").astype(np.int64).view(np.uint64)
            starts = group_starts(rows, TILE_KEYS)
            groups = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(codes)]))
            order = np.lexsort((gray_rank(codes), groups))
            codes = codes[order]
            label = np.arange(len(codes))
            for a, b in GrayIndex(codes, groups[order]).search(radius):
                unite(label, a, b)
            top = roots(label, np.arange(len(codes)))
            linked = top != np.arange(len(codes))
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes[linked].view(np.int64)), pa.array(codes[top[linked]].view(np.int64))],
                names=["u", "v"],
            )

    return link


def hamming_components(codes: DataFrame, radius: int) -> DataFrame:
    """(node, root) of every code that is linked to another within ``radius`` bits.

    ``codes`` has one column ``code`` without repeats or nulls. Inside a tile only links to
    a tile's own roots are put out, so dense groups give one row per code, not all pairs.
    """
    tiles = _tiled(codes, radius)
    dealt = tiles.repartition(*TILE_KEYS).sortWithinPartitions(*TILE_KEYS)
    return components(dealt.mapInArrow(_links(radius), "u long, v long"))


def _placed(rows: DataFrame, words_per_shingle: int, radius: int) -> DataFrame:
    """doc_id, code, root (the component's smallest code), component_id of every row."""
    spark = rows.sparkSession
    slim = rows.select("doc_id", simhash(F.col("text"), words_per_shingle).alias("code"))
    slim = stage(slim, scratch_path(spark, "fingerprints"))
    firsts = slim.groupBy("code").agg(F.min("doc_id").alias("first"))
    firsts = stage(firsts, scratch_path(spark, "codes"))
    linked = hamming_components(firsts.select("code"), radius)
    placed = firsts.join(linked.withColumnRenamed("node", "code"), "code", "left").select(
        "code", "first", F.coalesce("root", "code").alias("root")
    )
    names = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    by_code = placed.join(names, "root").select("code", "root", "component_id")
    return slim.join(by_code, "code").select("doc_id", "code", "root", "component_id")


def near_duplicates(rows: DataFrame, words_per_shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row per input row: doc_id, code (signed fingerprint), component_id.

    component_id is the smallest doc_id reachable through fingerprints at most ``radius``
    bits apart. Texts without words (empty, blank, null) have fingerprint zero and link as
    any other. Repeated rows stay repeated. A null doc_id takes part but names no component
    (component_id is null only if all its members' ids are). Other columns are not read, so
    their names cannot clash. An empty table gives an empty result.
    """
    return _placed(rows, words_per_shingle, radius).select("doc_id", "code", "component_id")


def keep_one_each(rows: DataFrame, words_per_shingle: int = 3, radius: int = 3) -> DataFrame:
    """The rows of a documents table with one row of each component: the smallest doc_id.

    Of rows that share that doc_id the least by text stays; if no member has a doc_id, one
    of the least text. All columns are kept as they are.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    found = _placed(rows, words_per_shingle, radius).where("doc_id <=> component_id")
    # One code per component, and how many rows share that code and id.
    rivals = found.groupBy("root", F.col("code").alias("_code"), key.alias("_id")).agg(F.count("*").alias("_n"))
    best = F.min_by(F.struct("_code", "_id", "_n"), "_code").alias("_w")
    winners = rivals.groupBy("root").agg(best).select("_w.*")
    winners = stage(winners, scratch_path(rows.sparkSession, "winners"))
    coded = rows.withColumn("_code", simhash(F.col("text"), words_per_shingle)).withColumn("_id", key)
    first = coded.join(winners.hint("merge"), ["_code", "_id"])
    row = F.struct(*[F.col(c) for c in rows.columns])
    least = F.min_by(row, F.coalesce("text", F.lit(""))).alias("_row")
    alone = first.where("_n = 1").select(*rows.columns)
    return alone.unionByName(first.where("_n > 1").groupBy("_code", "_id").agg(least).select("_row.*"))
