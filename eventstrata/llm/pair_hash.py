"""A minimal perfect hash over distinct 64-bit keys, built shard by shard."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventstrata.llm.common import group_starts, numbers, whole_groups

STEP = 0x9E3779B97F4A7C15
ALL = (1 << 64) - 1
SHARD = 1 << 15  # keys per shard, on average
SPREAD = 1.5  # bits per key that a level starts with


def scatter(keys: np.ndarray, round_: int) -> np.ndarray:
    """A 64-bit hash of each key, another one in every round."""
    z = keys.astype(np.int64).view(np.uint64) + np.uint64((round_ + 1) * STEP & ALL)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (scatter(keys, 0) >> np.uint64(33)).astype(np.int64) % shards


def build_shard(keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Levels of bits, and the keys in the order of their slots.

    A level's bit is set where exactly one of the keys left falls; keys that collide go on
    to the next level. A key's slot is the number of set bits before its own.
    """
    levels, placed, left, round_ = [], [], keys, 0
    while len(left):
        round_ += 1
        words = max(1, -(-int(len(left) * SPREAD) // 64))
        at = (scatter(left, round_) % np.uint64(words * 64)).astype(np.int64)
        alone = np.bincount(at, minlength=words * 64) == 1
        levels.append(np.packbits(alone, bitorder="little").view("<u8"))
        mine = alone[at]
        placed.append(left[mine][np.argsort(at[mine])])
        left = left[~mine]
    return levels, np.concatenate(placed) if placed else keys


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in whole_groups(batches, ["shard"]):
        starts = group_starts(rows, ["shard"])
        shard, key = numbers(rows, "shard"), numbers(rows, "key")
        for lo, hi in zip(starts, np.r_[starts[1:], rows.num_rows]):
            levels, order = build_shard(key[lo:hi])
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([int(shard[lo])], pa.int64()),
                    "levels": pa.array([[w.tobytes() for w in levels]], pa.list_(pa.binary())),
                    "keys": pa.array([order], pa.list_(pa.int64())),
                }
            )


class PerfectHash:
    """Slots 0 to n - 1 for n known keys; the keys are kept to verify every lookup."""

    def __init__(self, shards: list[list[bytes]], keys: np.ndarray):
        depth = max(map(len, shards), default=0)
        self.first = np.zeros((len(shards), depth), dtype=np.int64)
        self.bits = np.zeros((len(shards), depth), dtype=np.uint64)
        parts, word = [], 0
        for s, levels in enumerate(shards):
            for level, raw in enumerate(levels):
                self.first[s, level], self.bits[s, level] = word, len(raw) * 8
                word += len(raw) // 8
                parts.append(raw)
        self.words = np.frombuffer(b"".join(parts), dtype="<u8")
        set_bits = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(set_bits) - set_bits
        self.keys = keys

    def __len__(self) -> int:
        return len(self.keys)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Each key's slot. A key that the hash was not built from raises KeyError."""
        slot = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        shard = shard_of(keys, max(len(self.first), 1))
        for level in range(self.first.shape[1]):
            of = shard[left]
            there = self.bits[of, level] > 0
            left, of = left[there], of[there]
            if not len(left):
                break
            at = scatter(keys[left], level + 1) % self.bits[of, level]
            word = self.words[self.first[of, level] + (at >> np.uint64(6)).astype(np.int64)]
            one = np.uint64(1) << (at & np.uint64(63))
            hit = word & one != 0
            rank = self.before[self.first[of, level] + (at >> np.uint64(6)).astype(np.int64)]
            slot[left[hit]] = rank[hit] + np.bitwise_count(word[hit] & (one[hit] - np.uint64(1)))
            left = left[~hit]
        known = slot >= 0
        if not known.all() or not np.array_equal(self.keys[slot], keys):
            raise KeyError("a key that the hash was not built from")
        return slot


def perfect_hash(keys: DataFrame, count: int) -> PerfectHash:
    """The hash over the distinct values of a long column ``key`` of ``count`` rows.

    Shards of some 32,000 keys are built by as many tasks; bits and keys, about nine bytes
    per key, come to the driver, so the caller bounds ``count``.
    """
    shards = max(1, -(-count // SHARD))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = numbers(batch, "key")
            yield pa.RecordBatch.from_pydict({"shard": shard_of(key, shards), "key": key})

    dealt = keys.select(F.col("key").cast("long")).mapInArrow(deal, "shard long, key long")
    dealt = dealt.repartition("shard").sortWithinPartitions("shard")
    built = dealt.mapInArrow(_build, "shard long, levels array<binary>, keys array<long>").toArrow()
    levels: list[list[bytes]] = [[] for _ in range(shards)]
    ordered: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * shards
    for shard, raw, own in zip(built["shard"].to_pylist(), built["levels"].to_pylist(), built["keys"]):
        levels[shard], ordered[shard] = raw, own.values.to_numpy()
    return PerfectHash(levels, np.concatenate(ordered))
