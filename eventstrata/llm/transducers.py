"""Weighted finite-state machines over characters and pieces, and their tropical shortest path."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from heapq import heappop, heappush
from math import inf

import numpy as np

# Characters that say which lengths of pieces may follow.
LEAD = 3
# Reads or writes nothing; reads any character that no other arc of the state reads, and writes it.
NONE, ANY = -1, -2


class Machine:
    """Arcs in arrays, sorted by the state they leave: reads, writes, weight, to.

    Weights add up along a path, and of several paths the least weight counts (the tropical
    semiring). Labels are code points or piece ids, NONE or ANY. State 0 is the start.
    """

    def __init__(self, arcs: Iterable[tuple[int, int, int, float, int]], states: int):
        rows = sorted(arcs)
        columns = list(zip(*rows)) if rows else [()] * 5
        leaves, self.reads, self.writes = (np.array(c, dtype=np.int64) for c in columns[:3])
        self.weight, self.to = np.array(columns[3], dtype=float), np.array(columns[4], dtype=np.int64)
        self.first = np.searchsorted(leaves, np.arange(states + 1))

    def arcs(self, state: int) -> list[tuple[int, int, float, int]]:
        at = slice(self.first[state], self.first[state + 1])
        return list(
            zip(self.reads[at].tolist(), self.writes[at].tolist(), self.weight[at].tolist(), self.to[at].tolist())
        )


def normaliser(space: str) -> Machine:
    """Puts a space mark in front and writes one for every space."""
    mark = ord(space)
    return Machine([(0, NONE, mark, 0.0, 1), (1, ord(" "), mark, 0.0, 1), (1, ANY, ANY, 0.0, 1)], 2)


def rewriting(machine: Machine) -> tuple[str, list[tuple[str, str]]]:
    """A machine with one loop: what it writes first, and what its loop writes for what.

    Nothing that it writes is read by another of its arcs, so replacing one after the other
    is the same as running it.
    """
    (_, start, _, loop), = machine.arcs(0)
    pairs = [(chr(reads), chr(writes)) for reads, writes, _, _ in machine.arcs(loop) if reads != ANY]
    if {read for read, _ in pairs} & {written for _, written in pairs}:
        raise ValueError("an arc reads what another one writes")
    return chr(start), pairs


def speller(weights: dict[str, tuple[int, float]]) -> Machine:
    """Spells pieces from their characters: a trie whose ends lead back to its root.

    Arcs read a character and write nothing; a state that ends a piece has one arc to the
    root that reads nothing, writes the piece's id and has its weight.
    """
    states: dict[str, int] = {"": 0}
    arcs = []
    for piece, (number, weight) in weights.items():
        state = 0
        for end in range(1, len(piece) + 1):
            following = states.get(piece[:end])
            if following is None:
                following = states[piece[:end]] = len(states)
                arcs.append((state, ord(piece[end - 1]), NONE, 0.0, following))
            state = following
        arcs.append((state, NONE, number, weight, 0))
    return Machine(arcs, len(states))


class Lattice:
    """Composition of one input with a speller, a fallback and a machine over pieces.

    ``between(last, piece)`` is the weight, 0 or more, that the machine over pieces gives to
    ``piece`` behind ``last``; its states are the last pieces, START before the first one and
    behind fallback characters. None stands for a machine with one state and no weights.
    Nothing is composed before an input needs it.
    """

    START = -1

    def __init__(self, spell: Machine, fallback: float, between: Callable[[int, int], float] | None):
        self.fallback, self.between = fallback, between
        # The speller's paths from its root back to it: what they read, write and weigh. A
        # path is looked up by what it reads; the lengths that occur behind LEAD characters
        # say which to look up.
        self.spelled: dict[str, tuple[int, float]] = {}
        lengths: dict[str, set[int]] = {}
        todo = [(0, "")]
        while todo:
            state, read = todo.pop()
            for reads, writes, weight, to in spell.arcs(state):
                if reads != NONE:
                    todo.append((to, read + chr(reads)))
                    continue
                self.spelled[read] = (writes, weight)
                if len(read) > LEAD:
                    lengths.setdefault(read[:LEAD], set()).add(len(read))
        short = tuple(range(LEAD, 0, -1))
        self.lengths = {lead: (*sorted(found, reverse=True), *short) for lead, found in lengths.items()}
        self.short = short

    def leaving(self, text: str, at: int) -> Iterator[tuple[int, int, float]]:
        """(next position, label, weight) of all arcs from a position, the longest first.

        A character that is no piece by itself can fall back, its label being ~code point.
        """
        size = len(text)
        for length in self.lengths.get(text[at : at + LEAD], self.short):
            end = at + length
            if end <= size:
                found = self.spelled.get(text[at:end])
                if found is not None:
                    yield end, found[0], found[1]
                elif length == 1:
                    yield end, ~ord(text[at]), self.fallback

    def shortest(self, text: str) -> list[int]:
        """Labels along the path of least weight: piece ids, and ~code point for fallback."""
        if not text:
            return []
        if self.between is None:
            return self._by_position(text)
        return self._free(text, self.between) or self._best_first(text, self.between)

    def _by_position(self, text: str) -> list[int]:
        """One state per position: all arcs from left to right; of equal weights the first stays."""
        size = len(text)
        least, back = [inf] * (size + 1), [(0, NONE)] * (size + 1)
        least[0] = 0.0
        for at in range(size):
            for to, label, weight in self.leaving(text, at):
                if least[at] + weight < least[to]:
                    least[to], back[to] = least[at] + weight, (at, label)
        out, at = [], size
        while at > 0:
            at, label = back[at]
            out.append(label)
        return out[::-1]

    def _free(self, text: str, between: Callable[[int, int], float]) -> list[int] | None:
        """Labels along the path that weighs nothing, the one that _best_first takes; None without such a path.

        States that weigh nothing come before all others and the farthest first, which is
        depth first.
        """
        size, spelled, lengths, short = len(text), self.spelled.get, self.lengths.get, self.short
        labels, places, left = [self.START], [0], [iter(lengths(text[:LEAD], short))]
        seen = set()
        while left:
            at, last = places[-1], labels[-1]
            for length in left[-1]:
                end = at + length
                if end > size:
                    continue
                found = spelled(text[at:end])
                if found is None or found[1] or (end, found[0]) in seen:
                    continue
                if last >= 0 and between(last, found[0]):
                    continue
                labels.append(found[0])
                if end == size:
                    return labels[1:]
                seen.add((end, found[0]))
                places.append(end)
                left.append(iter(lengths(text[end : end + LEAD], short)))
                break
            else:
                for stack in (labels, places, left):
                    stack.pop()
        return None

    def _best_first(self, text: str, between: Callable[[int, int], float]) -> list[int]:
        """States (position, last piece) by weight, of equal ones the farthest first.

        Weights are never negative, so the first final state that is taken up ends a shortest
        path. A state's arcs that weigh nothing are taken one by one, the longest first, and
        the next only when the search comes back to the state; most arcs are never composed.
        """
        size = len(text)
        back: dict[tuple[int, int], tuple[tuple[int, int], int]] = {}
        # (weight, -position, number of the entry, state, its arcs that are left)
        first = (0, self.START)
        queue = [(0.0, 0, 0, first, self.leaving(text, 0))]
        count = 0
        while True:
            weight, far, _, here, arcs = queue[0]
            if here[0] == size:
                break
            for to, label, own in arcs:
                last = label if label >= 0 else self.START
                if (to, last) in back:
                    continue
                if label >= 0 and here[1] >= 0:
                    own += between(here[1], label)
                    if own == inf:
                        continue
                count += 1
                if own:
                    # Not before all that weighs less; until then the state is not settled.
                    heappush(queue, (weight + own, -to, count, (to, last, here, label), None))
                    continue
                back[to, last] = (here, label)
                heappush(queue, (weight, -to, count, (to, last), self.leaving(text, to)))
                break
            else:
                heappop(queue)
                while queue[0][4] is None:
                    weight, far, number, (to, last, source, label), _ = heappop(queue)
                    if (to, last) not in back:
                        back[to, last] = (source, label)
                        heappush(queue, (weight, far, number, (to, last), self.leaving(text, to)))
        out, here = [], queue[0][3]
        while here[0] > 0:
            here, label = back[here]
            out.append(label)
        return out[::-1]
