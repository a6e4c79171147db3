"""Packing token sequences: best-fit decreasing over a segment tree of open windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventstrata.llm.common import text_bytes
from eventstrata.llm.tokens import load_encoder

WINDOW = 2048
# Tokens that are packed together before their sequences are put out; bounds a task's memory.
BATCH_TOKENS = 1 << 22
PIECES = (
    "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class CapacityTree:
    """Open windows by remaining capacity, as counts over the capacities 0 to ``size``.

    ``tightest(n)`` finds the smallest capacity of at least n that some window has, in as
    many steps as the tree has levels.
    """

    def __init__(self, size: int):
        self.leaves = 1
        while self.leaves < size + 1:
            self.leaves *= 2
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, window: int, capacity: int) -> None:
        self.windows[capacity].append(window)
        self._change(capacity, 1)

    def pop(self, capacity: int) -> int:
        self._change(capacity, -1)
        return self.windows[capacity].pop()

    def _change(self, capacity: int, by: int) -> None:
        node = self.leaves + capacity
        while node:
            self.count[node] += by
            node >>= 1

    def tightest(self, least: int) -> int | None:
        node = self.leaves + least
        if self.count[node]:
            return least
        while node > 1:  # up until a subtree to the right holds a window, then down its left side
            if node % 2 == 0 and self.count[node + 1]:
                node += 1
                break
            node >>= 1
        else:
            return None
        while node < self.leaves:
            node = 2 * node if self.count[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit_decreasing(lengths: list[int], window: int = WINDOW) -> list[list[int]]:
    """Indices of ``lengths`` (each 1 to ``window``) per window, longest first, ties by index."""
    tree, windows = CapacityTree(window), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        capacity = tree.tightest(lengths[i])
        if capacity is None:
            windows.append([])
            at, capacity = len(windows) - 1, window
        else:
            at = tree.pop(capacity)
        windows[at].append(i)
        if capacity > lengths[i]:
            tree.add(at, capacity - lengths[i])
    return windows


def _is_full(total: int, window: int) -> bool:
    """Whether a sequence needs no padding: it fills the window or a power of two."""
    return total == window or total & (total - 1) == 0


def fill_gaps(windows: list[list[tuple]], window: int = WINDOW) -> list[list[tuple]]:
    """Cut the emptiest windows' pieces to fill the gaps of the others.

    Pieces are (document, start, length). What remains at the end is cut into sequences
    whose lengths are powers of two, so nothing is padded.
    """
    total = [sum(p[2] for p in w) for w in windows]
    done = [w for w, t in zip(windows, total) if _is_full(t, window)]
    short = sorted((i for i, t in enumerate(total) if not _is_full(t, window)), key=lambda i: (-total[i], i))
    left, right = 0, len(short) - 1
    spare: list[tuple] = []
    while left <= right:
        target = windows[short[left]]
        gap = window - total[short[left]]
        while gap and (spare or left < right):
            if not spare:
                spare = windows[short[right]]
                right -= 1
                continue
            doc, start, length = spare.pop()
            take = min(gap, length)
            target.append((doc, start, take))
            if take < length:
                spare.append((doc, start + take, length - take))
            gap -= take
        left += 1
        if gap:
            spare = target
        else:
            done.append(target)
    return done + _powers_of_two(spare, window)


def _powers_of_two(pieces: list[tuple], window: int) -> list[list[tuple]]:
    rest, out = sum(p[2] for p in pieces), []
    queue = list(pieces)
    while rest:
        size = min(window, 1 << (rest.bit_length() - 1))
        rest -= size
        sequence: list[tuple] = []
        while size:
            doc, start, length = queue.pop()
            take = min(size, length)
            sequence.append((doc, start, take))
            if take < length:
                queue.append((doc, start + take, length - take))
            size -= take
        out.append(sequence)
    return out


def pack(lengths: list[int], window: int = WINDOW) -> list[list[tuple]]:
    """Sequences of pieces (document index, start, length) for documents of these lengths.

    A document longer than the window is first cut into full windows; the rests are packed
    best-fit decreasing; gaps are filled by cutting. Documents without tokens get no piece.
    """
    full = [[(d, s, window)] for d, n in enumerate(lengths) for s in range(0, n - n % window, window)]
    rests = [(d, n - n % window, n % window) for d, n in enumerate(lengths) if n % window]
    fitted = best_fit_decreasing([r[2] for r in rests], window)
    return full + fill_gaps([[rests[i] for i in w] for w in fitted], window)


def _pack_partition(tokenizer: str, end_id: int, window: int, id_type: pa.DataType) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load_encoder(tokenizer)
        sequence = TaskContext.get().partitionId() << 36
        names: list = []
        ids: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal sequence
            columns: list[list[int]] = [[] for _ in range(7)]
            for pieces in pack([len(x) for x in ids], window):
                offset = 0
                for doc, start, length in pieces:
                    part = ids[doc][start : start + length]
                    row = (names[doc], start, length, crc32(part.tobytes()), len(ids[doc]), sequence, offset)
                    for column, value in zip(columns, row):
                        column.append(value)
                    offset += length
                sequence += 1
            arrays = [pa.array(columns[0], id_type), *[pa.array(c, pa.int64()) for c in columns[1:]]]
            return pa.RecordBatch.from_arrays(
                arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            )

        for batch in batches:
            for name, text in zip(batch.column("doc_id").to_pylist(), text_bytes(batch.column("text"))):
                tokens = np.array([*encode((text or b"").decode("utf-8", "replace")), end_id], dtype="<u4")
                names.append(name)
                ids.append(tokens)
                held += len(tokens)
                if held >= BATCH_TOKENS:
                    yield flush()
                    names, ids, held = [], [], 0
        if ids:
            yield flush()

    return run


def pack_documents(
    documents: DataFrame, tokenizer: str, end_id: int = 1, window: int = WINDOW
) -> DataFrame:
    """One row per piece of a document: where it starts, its length and checksum, its place.

    A document is its token ids and ``end_id``; null and empty texts are ``end_id`` alone.
    Every task packs its own documents, some million tokens at a time, so nothing is
    shuffled or collected. sequence_id starts from the partition's number and is unique; a
    null doc_id stays null and repeated rows are packed each on its own. Other columns are
    not read. An empty table gives an empty result. A document of any length is encoded
    whole; its rest shares sequences with others.
    """
    kind = documents.schema["doc_id"].dataType
    id_type = pa.int32() if kind.simpleString() == "int" else pa.int64()
    if kind.simpleString() not in ("int", "bigint"):
        raise TypeError(f"doc_id must be an integer, got {kind.simpleString()}")
    schema = PIECES.format(id=kind.simpleString())
    return documents.select("doc_id", "text").mapInArrow(
        _pack_partition(tokenizer, end_id, window, id_type), schema
    )


def padding(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row: sequences, tokens, and padding needed up to the window or none at a power of two."""
    sizes = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    padded = F.when(F.col("n").bitwiseAND(F.col("n") - 1) == 0, 0).otherwise(window - F.col("n"))
    return sizes.agg(
        F.count("*").alias("sequences"), F.sum("n").alias("tokens"), F.sum(padded).alias("padding")
    )
