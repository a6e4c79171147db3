"""Alignment of two tokenizers' tokens, and how often ids meet over a whole corpus."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventstrata.llm.dense import part_number, rows_of, schema, tree_sum
from eventstrata.llm.pair_hash import PerfectHash, perfect_hash
from eventstrata.llm.tokens import byte_of_symbol, load_encoder
from eventstrata.session import scratch_path, stage, stage_counted

SPACE = "▁"
# Characters that are encoded and tokens that are aligned together, whatever the batches: a task's
# memory follows these and its longest text. Counts per block of the summed vector.
CHARACTERS, TOKENS, BLOCK = 1 << 18, 1 << 18, 1 << 14
# Distinct pairs up to which hash, keys and counts (about 18 bytes a pair) go to every task.
MAX_PAIRS = 1 << 22
# Ids as little-endian numbers of two or four bytes, whichever the vocabulary needs.
ENCODED = "doc_id long, row long, a binary, b binary"
COUNTED = "n_a long, n_b long, n_groups long, n_links long"


@lru_cache(maxsize=4)
def byte_level_tokens(path: str) -> tuple[bytes, ...]:
    """Bytes of every id of a byte-level tokenizer file."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    symbol = byte_of_symbol()
    added = {t["content"] for t in spec["added_tokens"]}
    found = {i: t.encode() if t in added else bytes(symbol[c] for c in t) for t, i in spec["model"]["vocab"].items()}
    found |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    return tuple(found.get(i, b"") for i in range(max(found) + 1))


@lru_cache(maxsize=4)
def piece_model(path: str) -> tuple[sentencepiece.SentencePieceProcessor, tuple[bytes, ...]]:
    """A sentence-piece model and the bytes of its ids."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    raw = [
        bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(SPACE, " ").encode()
        for i, p in enumerate(names)
    ]
    return model, tuple(raw)


def id_type(vocabulary: int) -> np.dtype:
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")


def _encode(path_a: str, path_b: str):
    def one(ids: pa.Array, rows: pa.Array, texts: list[str | None]) -> pa.RecordBatch:
        encode = load_encoder(path_a, special=False)
        bytes_a = byte_level_tokens(path_a)
        model, bytes_b = piece_model(path_b)
        kinds = id_type(len(bytes_a)), id_type(len(bytes_b))
        a, b = [], []
        filled = [t for t in texts if t]
        pieces = iter(model.encode(filled, num_threads=1) if filled else [])
        for text in texts:
            if not text:
                a.append(b"")
                b.append(b"")
                continue
            left, right, whole = encode(" " + text), next(pieces), (" " + text).encode()
            same = b"".join([bytes_a[i] for i in left]) == whole == b"".join([bytes_b[i] for i in right])
            a.append(np.array(left, dtype=kinds[0]).tobytes() if same else b"")
            b.append(np.array(right, dtype=kinds[1]).tobytes() if same else b"")
        arrays = [ids, rows, pa.array(a, pa.binary()), pa.array(b, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "row", "a", "b"])

    def encode_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            lo = held = 0
            for at, text in enumerate(texts):
                held += len(text or "")
                if held >= CHARACTERS or at == len(texts) - 1:
                    width = at + 1 - lo
                    yield one(batch.column(0).slice(lo, width), batch.column(1).slice(lo, width), texts[lo : at + 1])
                    lo, held = at + 1, 0

    return encode_all


def encoded(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Both tokenizers' ids of every document, staged, with a number per row.

    A is a byte-level file and sees a space before the text, B a sentence-piece model that
    adds it. Special tokens' strings are plain text. Ids are empty where the text is null or
    empty or where either tokenizer's bytes differ from the space and the text.
    """
    slim = documents.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    return stage(slim.mapInArrow(_encode(path_a, path_b), ENCODED), scratch_path(documents.sparkSession, "token-ids"))


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in slices of some TOKENS tokens, at two bytes each."""
    for batch in batches:
        tokens = sum(np.asarray(pc.binary_length(batch.column(name))).astype(np.int64) // 2 for name in "ab")
        portion = (np.cumsum(tokens) - tokens) // TOKENS
        starts = np.flatnonzero(np.r_[True, np.diff(portion) > 0])[: batch.num_rows]
        for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows]):
            yield batch.slice(lo, hi - lo)


class Aligned:
    """The documents of one batch: their tokens end to end, and the tokens that end together.

    Both sides of a document span the same bytes, so running byte ends over the whole batch
    compare documents only with themselves. No token is empty, so a place where both sides
    end is a link of one token of each.
    """

    def __init__(self, batch: pa.RecordBatch, lengths: tuple[np.ndarray, np.ndarray]):
        self.rows = batch.num_rows
        self.size, ids, ends = [], [], []
        for name, length in zip("ab", lengths):
            kind = id_type(len(length))
            packed = batch.column(name).cast(pa.large_binary())
            self.size.append(np.asarray(pc.binary_length(packed)).astype(np.int64) // kind.itemsize)
            ids.append(np.frombuffer(b"".join(packed.to_pylist()), dtype=kind).astype(np.int64))
            ends.append(np.cumsum(length[ids[-1]]))
        self.a, self.b = ids
        near = np.searchsorted(ends[1], ends[0])
        self.at_a = np.flatnonzero(ends[1][near] == ends[0])
        self.at_b = near[self.at_a]
        owner = np.repeat(np.arange(self.rows), self.size[0])
        self.row = owner[self.at_a]

    def links(self) -> np.ndarray:
        """One number per link: A's id in the high half, B's in the low."""
        return self.a[self.at_a] << 32 | self.b[self.at_b]

    def per_row(self, values: np.ndarray) -> np.ndarray:
        """Sums of whole numbers over each document's links."""
        running = np.r_[0, np.cumsum(values, dtype=np.int64)]
        last = np.cumsum(np.bincount(self.row, minlength=self.rows))
        return running[last] - running[np.r_[0, last[:-1]]]

    def groups(self, names: np.ndarray) -> list[str]:
        """Every document's groups: ``a1,a2|b1;a3|b2,b3``."""
        parts, keys = [], []
        for side, (ids, last) in enumerate(((self.a, self.at_a), (self.b, self.at_b))):
            ending = np.zeros(len(ids), dtype=bool)
            ending[last] = True
            parts.append(names[ending.astype(int), side, ids])
            keys.append(2 * (np.cumsum(ending) - ending) + side)
        order = np.argsort(np.concatenate(keys), kind="stable")
        text = np.concatenate(parts)[order].tolist()
        ends = np.cumsum(self.size[0] + self.size[1]).tolist()
        return ["".join(text[lo:hi])[:-1] for lo, hi in zip([0, *ends[:-1]], ends)]


def _decimals(sizes: tuple[int, int]) -> np.ndarray:
    """names[ends a group, side, id]: the decimal id with the separator after it."""
    names = np.empty((2, 2, max(sizes)), dtype=object)
    for ending, marks in enumerate((",,", "|;")):
        for side, mark in enumerate(marks):
            names[ending, side] = [f"{i}{mark}" for i in range(max(sizes))]
    return names


@lru_cache(maxsize=2)
def _tables(path_a: str, path_b: str) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    sides = byte_level_tokens(path_a), piece_model(path_b)[1]
    lengths = tuple(np.array([len(t) for t in side], dtype=np.int64) for side in sides)
    return lengths, _decimals((len(sides[0]), len(sides[1])))


def _distinct(lengths) -> Callable:
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            yield pa.RecordBatch.from_pydict({"key": np.unique(Aligned(batch, lengths).links())})

    return pairs


def _vector(lengths, shared) -> Callable:
    """A task's dense counts, the blocks that hold any."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed: PerfectHash = shared.value
        blocks = -(-len(hashed) // BLOCK)
        total = np.zeros(blocks * BLOCK, dtype=np.int64)
        for batch in _portions(batches):
            total += np.bincount(hashed.slots(Aligned(batch, lengths).links()), minlength=len(total))
        square = total.reshape(-1, BLOCK)
        used = np.flatnonzero(square.any(axis=1))
        for at in used:
            yield rows_of(np.array([at]), part_number(), square[at : at + 1])

    return count


def _looked_up(tables, shared) -> Callable:
    """The second pass: documents aligned anew, each link's count by its slot."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, counts, highest = shared.value
        for batch in _portions(batches):
            found = Aligned(batch, tables[0])
            key = found.links()
            count = counts[hashed.slots(key)]
            best = count == highest[key & 0xFFFFFFFF]
            yield _row_batch(batch, found, tables[1], found.per_row(best), found.per_row(count))

    return look


def _row_batch(batch: pa.RecordBatch, found: Aligned, names: np.ndarray, *more: np.ndarray) -> pa.RecordBatch:
    links = found.per_row(np.ones(len(found.row), dtype=np.int64))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("row")]
        + [pa.array(v, pa.int64()) for v in (*found.size, links, links, *more)]
        + [pa.array(found.groups(names))],
        names=["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", *["n_best", "count_sum"][: len(more)], "groups"],
    )


def _per_document(tables) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            yield _row_batch(batch, Aligned(batch, tables[0]), tables[1])

    return rows


def _links_by_row(lengths) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            found = Aligned(batch, lengths)
            number, key = batch.column("row").to_numpy()[found.row], found.links()
            order = np.lexsort((key, number))
            number, key = number[order], key[order]
            new = np.flatnonzero(np.r_[True, (number[1:] != number[:-1]) | (key[1:] != key[:-1])]) if len(key) else order
            times = np.diff(np.r_[new, len(key)])
            yield pa.RecordBatch.from_pydict({"row": number[new], "key": key[new], "n": times})

    return rows


def _counted_by_hash(ids: DataFrame, keys: DataFrame, n: int, tables) -> DataFrame:
    spark = ids.sparkSession
    hashed = perfect_hash(keys, n)
    # Partial vectors follow the cluster's size, however many files there are.
    slots = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    few = ids.coalesce(slots)
    parts = few.mapInArrow(_vector(tables[0], spark.sparkContext.broadcast(hashed)), schema("long"))
    counts = np.zeros(-(-n // BLOCK) * BLOCK, dtype=np.int64)
    for row in tree_sum(parts, "long").toLocalIterator():
        counts[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = row["values"]
    counts = counts[:n]
    highest = np.zeros(len(tables[0][1]), dtype=np.int64)
    np.maximum.at(highest, hashed.keys & 0xFFFFFFFF, counts)
    shared = spark.sparkContext.broadcast((hashed, counts, highest))
    kind = f"doc_id long, row long, {COUNTED}, n_best long, count_sum long, groups string"
    return ids.mapInArrow(_looked_up(tables, shared), kind).drop("row")


def _counted_by_join(ids: DataFrame, tables) -> DataFrame:
    """The same for more pairs than a task may hold: counts joined to every document's pairs."""
    spark = ids.sparkSession
    own = stage(ids.mapInArrow(_links_by_row(tables[0]), "row long, key long, n long"), scratch_path(spark, "pairs"))
    counts = own.groupBy("key").agg(F.sum("n").alias("count"))
    counts = stage(counts.withColumn("b", F.col("key").bitwiseAND(F.lit(0xFFFFFFFF))), scratch_path(spark, "counts"))
    counts = counts.join(counts.groupBy("b").agg(F.max("count").alias("highest")), "b")
    sums = own.join(counts, "key").groupBy("row").agg(
        F.sum(F.when(F.col("count") == F.col("highest"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("count")).alias("count_sum"),
    )
    rows = ids.mapInArrow(_per_document(tables), f"doc_id long, row long, {COUNTED}, groups string")
    filled = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")]
    rest = [c.split()[0] for c in COUNTED.split(", ")]
    return rows.join(sums, "row", "left").select("doc_id", *rest, *filled, "groups")


def alignments(documents: DataFrame, path_a: str, path_b: str, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """One row per document: its groups of tokens that span the same bytes, and their counts.

    ``groups`` lists ids as ``a1,a2|b1;a3|b2,b3``: cut wherever tokens of both sides end. The
    two tokens that end a group are a link; a pair's count is its number of links in the
    whole corpus. n_best counts the links whose pair is the commonest of its B id (ties
    count), count_sum adds up the links' counts. Texts that are null, empty or not spelled
    by both tokenizers have no tokens: zeros and no groups. Repeated rows count repeatedly
    and come out repeatedly; null ids are kept; other columns are not read; an empty table
    gives an empty result.

    Documents are tokenized once; their ids are staged and aligned anew in each pass. The
    distinct pairs get a minimal perfect hash, every task counts into a vector indexed by it,
    a tree of tasks adds the vectors, and the last pass looks counts up, verifying each key.
    Pairs are at most the product of the vocabularies; beyond ``max_pairs`` distinct ones
    nothing is broadcast and the counts are joined to each document's pairs.
    """
    ids = encoded(documents, path_a, path_b)
    tables = _tables(path_a, path_b)
    pairs = ids.mapInArrow(_distinct(tables[0]), "key long").distinct()
    keys, n = stage_counted(pairs, scratch_path(documents.sparkSession, "distinct-pairs"))
    if n > max_pairs:
        return _counted_by_join(ids, tables)
    return _counted_by_hash(ids, keys, n, tables)
