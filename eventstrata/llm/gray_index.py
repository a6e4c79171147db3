"""Hierarchical index over fingerprints in Gray order, for Hamming search inside a task."""

from __future__ import annotations

import numpy as np

ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
FANOUT = 8
# Pairs of query and node that one search step may hold at once.
FRONTIER = 1 << 20


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence; neighbours differ in few bits."""
    rank = codes.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return rank


class GrayIndex:
    """Trees over sorted groups of codes, all built and searched together.

    ``codes`` must be sorted by (group, Gray rank). Eight neighbours share a node, which
    holds the bits they all have in common; a bit common to a whole parent is factored out
    of its children. Going down, the differences with the query add up level by level, and
    a node whose sum exceeds the radius is dropped with everything under it.
    """

    def __init__(self, codes: np.ndarray, groups: np.ndarray):
        self.codes, self.groups = codes, groups
        ones, ors, owner = codes, codes, groups
        self.levels: list[dict[str, np.ndarray]] = []
        while True:
            fixed = ones | ~ors
            level = {"pattern": ones, "fixed": fixed, "own": fixed}
            self.levels.append(level)
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            if len(first) == len(owner):
                self.top_of = owner
                break
            size = np.diff(np.r_[first, len(owner)])
            place = np.arange(len(owner)) - np.repeat(first, size)
            start = np.flatnonzero(place % FANOUT == 0)
            parent = np.cumsum(place % FANOUT == 0) - 1
            ones = np.bitwise_and.reduceat(ones, start)
            ors = np.bitwise_or.reduceat(ors, start)
            level["own"] = fixed & ~(ones | ~ors)[parent]
            level["start_in_parent"] = start
            owner = owner[start]
        for below, above in zip(self.levels, self.levels[1:]):
            above["first_child"] = below["start_in_parent"]
            above["children"] = np.diff(np.r_[below["start_in_parent"], len(below["pattern"])])

    def search(self, radius: int):
        """Yield arrays (query row, found row) of codes of one group within the radius.

        Each unordered pair comes once; queries go in blocks so that memory stays bounded.
        """
        if len(self.codes) < 2:
            return
        tops = np.searchsorted(self.top_of, self.groups)
        sizes = np.bincount(tops)[tops]
        block = np.cumsum(sizes) // FRONTIER
        edges = np.r_[np.flatnonzero(np.r_[True, block[1:] != block[:-1]]), len(block)]
        for lo, hi in zip(edges[:-1], edges[1:]):
            query = np.arange(lo, hi)
            node, far = tops[lo:hi], np.zeros(hi - lo, dtype=np.uint8)
            for level in reversed(self.levels):
                differ = (self.codes[query] ^ level["pattern"][node]) & level["own"][node]
                far = far + np.bitwise_count(differ)
                near = far <= radius
                query, node, far = query[near], node[near], far[near]
                if level is self.levels[0]:
                    break
                width = level["children"][node]
                first = np.repeat(level["first_child"][node] - np.r_[0, np.cumsum(width)[:-1]], width)
                query, far = np.repeat(query, width), np.repeat(far, width)
                node = first + np.arange(len(query))
            forward = query < node
            yield query[forward], node[forward]


def roots(label: np.ndarray, at: np.ndarray) -> np.ndarray:
    top = label[at]
    while True:
        above = label[top]
        if np.array_equal(above, top):
            label[at] = top
            return top
        top = above


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the sets of a[i] and b[i]; a label always points to a smaller row or itself."""
    while len(a):
        ra, rb = roots(label, a), roots(label, b)
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))
