"""MinHash near-duplicates: SuperMinHash signatures, banding, verified links, components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventstrata.llm.common import group_starts, text_bytes, whole_groups
from eventstrata.llm.graph import components
from eventstrata.session import scratch_path, stage

SEED = 42
STEP = np.uint64(0x9E3779B97F4A7C15)
LOW32, HALF = np.uint64(0xFFFFFFFF), np.uint64(32)
ALL = (1 << 64) - 1
# Shingles whose permutations are held at once, and shingles of texts signed together.
BLOCK, FLUSH = 1 << 14, 1 << 20
CLASS = pa.decimal128(38, 0)


@dataclass(frozen=True)
class MinHash:
    """Two sets of similarity 0.8 share no band with probability (1 - 0.8 ** rows) ** bands: 3e-6."""

    words: int = 4  # per shingle
    percent: int = 80  # of the union that two linked documents share at least
    bands: int = 32
    rows: int = 5
    sketch: int = 64  # signature slots kept as one byte each, to tell apart a band's members
    agree: int = 32  # of them that candidates share; at similarity 0.8 fewer have odds of 1e-8
    tile: int = 4096  # candidates of a band value that one group compares
    tile_shingles: int = 1 << 21  # shingles of a family that are verified against as many


def mix(z: np.ndarray) -> np.ndarray:
    """Finaliser of a counter-based generator: every input bit reaches every output bit."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def shingles(text: bytes | None, width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of ``width`` words; a shorter text is one run."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(length + 1) - 1
    width = min(width, len(words))
    starts, ends = (end - length)[: len(words) - width + 1].tolist(), end[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends)], dtype=np.uint64))


def signatures(hashes: np.ndarray, owner: np.ndarray, sets: int, slots: int) -> np.ndarray:
    """SuperMinHash of several sets at once: sets x slots ranks.

    Element e permutes the slots; the slot that its step j reaches gets rank j plus a random
    fraction, and a slot keeps its least rank. Steps run in parallel over all elements.
    Later steps only bring larger ranks, so a set is done with the first step that all its
    slots undercut: one or two steps for sets much larger than the signature. ``owner``
    names each element's set and rises. Ranks hold the step in the high half.
    """
    least = np.full((sets, slots), np.uint64(ALL))
    flat = least.reshape(-1)
    for lo in range(0, len(hashes), BLOCK):
        element, own = hashes[lo : lo + BLOCK], owner[lo : lo + BLOCK]
        place = np.repeat(np.arange(slots, dtype=np.int16)[None, :], len(element), axis=0)
        for j in range(slots):
            if j:
                unfinished = least[own[0] : own[-1] + 1].max(axis=1) >= np.uint64(j) << HALF
                stay = unfinished[own - own[0]]
                if not stay.all():
                    element, own, place = element[stay], own[stay], place[stay]
                if not len(element):
                    break
            drawn = mix(element + np.uint64((j + 1) * int(STEP) & ALL))
            at = j + ((drawn & LOW32) * np.uint64(slots - j) >> HALF).astype(np.int64)
            row = np.arange(len(element))
            slot = place[row, at]
            place[row, at] = place[:, j]
            np.minimum.at(flat, own * slots + slot, np.uint64(j) << HALF | drawn >> HALF)
    return least


def digest120(hashes: np.ndarray) -> bytes:
    """A set's name: 120 bits, as 16 bytes of a non-negative decimal(38, 0)."""
    return xxhash.xxh3_128_digest(hashes.tobytes())[:15] + b"\0"


def class_column(names: list[bytes | None]) -> pa.Array:
    raw = b"".join(n or b"\0" * 16 for n in names)
    there = pa.array([n is not None for n in names], pa.bool_())
    filled = pa.Array.from_buffers(CLASS, len(names), [None, pa.py_buffer(raw)])
    return pc.if_else(there, filled, pa.scalar(None, CLASS))


SIGNED = "doc_id long, row_key long, n_shingles long, cls decimal(38,0), bands array<long>, sketch binary"


def may_differ(percent: int) -> int:
    """Least size of a set that can reach ``percent`` with a set other than itself."""
    size = 1
    while 100 * size < percent * (size + 1):
        size += 1
    return size


def _signed(how: MinHash):
    slots, least_size = how.bands * how.rows, may_differ(how.percent)
    keep = np.linspace(0, slots - 1, how.sketch).astype(int)

    def one(ids: pa.Array, keys: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        names = [digest120(s) if len(s) else None for s in sets]
        signed = np.flatnonzero(sizes >= least_size)
        bands = [None] * len(sets)
        sketch = [None] * len(sets)
        if len(signed):
            owner = np.repeat(np.arange(len(signed)), sizes[signed])
            ranks = signatures(np.concatenate([sets[i] for i in signed]), owner, len(signed), slots)
            value = np.tile(np.arange(how.bands, dtype=np.uint64), (len(signed), 1))
            for r in range(how.rows):
                value = mix((value ^ ranks[:, r :: how.rows]) * STEP + STEP)
            short = mix(ranks[:, keep]).astype(np.uint8)
            for i, v, s in zip(signed.tolist(), value.view(np.int64).tolist(), short):
                bands[i], sketch[i] = v, s.tobytes()
        return pa.RecordBatch.from_arrays(
            [ids, keys, pa.array(sizes), class_column(names), pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
            names=["doc_id", "row_key", "n_shingles", "cls", "bands", "sketch"],
        )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo, held, sets = 0, 0, []
            for at, text in enumerate(text_bytes(batch.column(2))):
                sets.append(shingles(text, how.words))
                held += len(sets[-1])
                if held >= FLUSH or at == batch.num_rows - 1:
                    width = at + 1 - lo
                    yield one(batch.column(0).slice(lo, width), batch.column(1).slice(lo, width), sets)
                    lo, held, sets = at + 1, 0, []

    return sign


def _connected(size: int, like) -> Iterator[tuple[int, np.ndarray]]:
    """Links (row, rows) that connect exactly the rows connected by ``like(row, rows)``.

    Each row met is compared with all rows not yet met, so every link between parts that
    are not connected otherwise is tried; a family costs one comparison per member.
    """
    rest, queue = np.arange(1, size), [0]
    while len(rest):
        if queue:
            row = queue.pop()
        else:
            row, rest = int(rest[0]), rest[1:]
            if not len(rest):
                return
        linked = like(row, rest)
        if linked.any():
            yield row, rest[linked]
            queue += rest[linked].tolist()
            rest = rest[~linked]


def _link_batch(cls: pa.Array, low: list[np.ndarray], high: list[np.ndarray]) -> pa.RecordBatch:
    u = np.concatenate(low) if low else np.zeros(0, dtype=np.int64)
    v = np.concatenate(high) if high else np.zeros(0, dtype=np.int64)
    return pa.RecordBatch.from_arrays([cls.take(pa.array(u)), cls.take(pa.array(v))], names=["u", "v"])


LINK = "u decimal(38,0), v decimal(38,0)"
TILE = ["key", "low", "high"]


def _candidates(how: MinHash):
    """Links inside the tiles of a band between sets whose sketches agree well enough."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, TILE):
            starts = group_starts(rows, TILE)
            sizes = np.diff(np.r_[starts, rows.num_rows])
            joined = b"".join(rows.column("sketch").to_pylist())
            sketch = np.frombuffer(joined, dtype=np.uint8).reshape(rows.num_rows, -1)
            first = np.repeat(starts, sizes)
            same = (sketch == sketch[first]).sum(axis=1) >= how.agree
            same[starts] = False
            whole = np.add.reduceat(same, starts) == sizes - 1
            take = np.flatnonzero(same & np.repeat(whole, sizes))
            low, high = [take], [first[take]]
            for g in np.flatnonzero(~whole):
                at = starts[g]
                mine = sketch[at : at + sizes[g]]
                for row, others in _connected(
                    int(sizes[g]), lambda x, rest: (mine[rest] == mine[x]).sum(axis=1) >= how.agree
                ):
                    low.append(at + others)
                    high.append(np.full(len(others), at + row))
            yield _link_batch(rows.column("cls").combine_chunks(), low, high)

    return link


def _tiles(rows: DataFrame, salts: str, name: str) -> DataFrame:
    """Rows of a group with many salts once per pair of salts that holds their own."""
    own = F.pmod(F.xxhash64(name), F.col(salts)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col(salts) - 1)).alias("_other")
    dealt = rows.withColumn("_own", own).select("*", other)
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    return dealt.withColumn("low", low).withColumn("high", high).drop("_own", "_other", salts)


def _families(classes: DataFrame, how: MinHash) -> DataFrame:
    """(node, root): sets that candidates connect. A superset of all links that bands find."""
    keyed = classes.where("bands is not null").select("cls", F.explode("bands").alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    salts = F.ceil(F.col("n") / how.tile).cast("int")
    shared = keyed.join(sizes.select("key", salts.alias("salts")), "key")
    shared = shared.join(classes.select("cls", "sketch"), "cls")
    dealt = _tiles(shared, "salts", "cls").repartition(*TILE).sortWithinPartitions(*TILE)
    return components(dealt.mapInArrow(_candidates(how), LINK))


def _sets(how: MinHash):
    """Shingle hashes of each class once per task, from any row that has its text."""

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # equal rows come one after the other
        for batch in batches:
            names, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at, text in enumerate(text_bytes(batch.column("text"))):
                if (names[at], keys[at]) == last:
                    continue
                found = shingles(text, how.words)
                if class_column([digest120(found)])[0].as_py() != names[at]:
                    continue  # another text with the same key
                last = (names[at], keys[at])
                one = batch.slice(at, 1)
                lists = pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), pa.array(found.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [one.column("cls"), one.column("root"), one.column("salts"), lists],
                    names=["cls", "root", "salts", "hashes"],
                )

    return load


FAMILY = ["root", "low", "high"]


def _verified(how: MinHash):
    """Links between the sets of one tile that share enough of their union, sets in full."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, FAMILY):
            starts = group_starts(rows, FAMILY)
            ends = np.r_[starts[1:], rows.num_rows]
            cls = rows.column("cls").combine_chunks()
            lists = rows.column("hashes").combine_chunks()
            low, high = [], []
            for lo, hi in zip(starts, ends):
                if hi - lo < 2:
                    continue
                part = lists.slice(lo, hi - lo)
                size = np.asarray(part.value_lengths())
                _, code = np.unique(part.flatten().to_numpy(), return_inverse=True)
                begin = np.r_[0, np.cumsum(size)]
                mark = np.zeros(int(code.max()) + 1, dtype=bool)

                def like(row: int, rest: np.ndarray) -> np.ndarray:
                    mine = code[begin[row] : begin[row + 1]]
                    mark[mine] = True
                    width = size[rest]
                    first = np.r_[0, np.cumsum(width)[:-1]]
                    at = np.arange(int(width.sum())) + np.repeat(begin[rest] - first, width)
                    both = np.add.reduceat(mark[code[at]], first, dtype=np.int64)
                    mark[mine] = False
                    return 100 * both >= how.percent * (size[row] + width - both)

                for row, others in _connected(int(hi - lo), like):
                    low.append(lo + others)
                    high.append(np.full(len(others), lo + row))
            yield _link_batch(cls, low, high)

    return link


def _links(documents: DataFrame, classes: DataFrame, how: MinHash) -> DataFrame:
    """Verified links that connect the sets of every family as all its links would."""
    families = _families(classes, how).withColumnRenamed("node", "cls")
    members = families.join(classes.select("cls", "row_key", "n_shingles"), "cls")
    sizes = members.groupBy("root").agg(F.ceil(F.sum("n_shingles") / how.tile_shingles).cast("int").alias("salts"))
    members = members.join(sizes, "root").select("cls", "row_key", "root", "salts")
    texts = documents.select(F.xxhash64("doc_id", "text").alias("row_key"), "text")
    loaded = members.join(texts, "row_key").select("cls", "row_key", "root", "salts", "text")
    sets = loaded.mapInArrow(_sets(how), "cls decimal(38,0), root decimal(38,0), salts int, hashes array<long>")
    dealt = _tiles(sets, "salts", "cls").repartition(*FAMILY).sortWithinPartitions(*FAMILY)
    return dealt.mapInArrow(_verified(how), LINK)


def near_duplicates(documents: DataFrame, how: MinHash = MinHash()) -> DataFrame:
    """One row per row of ``documents``: doc_id, n_shingles, component_id, kept.

    A document's set are its distinct runs of four words, lower-cased A-Z; fewer words are
    one run. Documents whose sets share at least 80 % of their union are linked;
    component_id is the smallest doc_id reachable, kept says that it is the row's own. Texts
    that are null or without words have no set and link with nothing, not even each other.
    Equal sets are one class from the first shuffle on. Repeated rows stay repeated and
    share their component, as do rows that repeat a doc_id only if their texts link. Null
    ids take part but name a component only if no member has an id. Other columns are not
    read. An empty table gives an empty result.

    Bands propose, sketches thin out, full sets decide. Inside a band value and inside a
    family of candidates rows are dealt to tiles of bounded size, every pair of tiles meets,
    and only links that connect something new are put out: no links are left out and no
    group makes all its pairs. Sets are compared by 64-bit hashes of their members.
    """
    spark = documents.sparkSession
    slim = documents.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), "text")
    signed = stage(slim.mapInArrow(_signed(how), SIGNED), scratch_path(spark, "signatures"))
    classes = signed.where("cls is not null").groupBy("cls").agg(
        F.min("doc_id").alias("first_id"),
        F.min("row_key").alias("row_key"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch"),
    )
    classes = stage(classes, scratch_path(spark, "classes"))
    linked = components(_links(documents, classes, how)).withColumnRenamed("node", "cls")
    placed = classes.select("cls", "first_id").join(linked, "cls", "left")
    placed = placed.select("cls", "first_id", F.coalesce("root", "cls").alias("root"))
    names = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_class = placed.join(names, "root").select("cls", "component_id")
    rows = signed.where("cls is not null").join(by_class, "cls")
    alone = signed.where("cls is null").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id", F.expr("doc_id <=> component_id").alias("kept")]
    return rows.select(*columns).unionByName(alone.select(*columns))
