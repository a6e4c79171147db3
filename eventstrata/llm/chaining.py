"""Collinear chaining of seed matches and word alignment of the chains, for one task."""

from __future__ import annotations

import numpy as np

# Cost of a word that a chain skips, per document side.
GAP_COST = 0.5
# An end is extended until so many more words differ than agree since its best point.
X_DROP = 10


class PrefixMax:
    """Fenwick tree: the best (value, item) over ranks up to a bound."""

    def __init__(self, size: int):
        self.best: list[tuple[float, int]] = [(-np.inf, -1)] * (size + 1)

    def put(self, rank: int, value: float, item: int) -> None:
        at = rank + 1
        while at < len(self.best):
            if self.best[at][0] < value:
                self.best[at] = (value, item)
            at += at & -at

    def get(self, rank: int) -> tuple[float, int]:
        at, found = rank + 1, (-np.inf, -1)
        while at:
            if self.best[at][0] > found[0]:
                found = self.best[at]
            at -= at & -at
        return found


def fragments(p: np.ndarray, q: np.ndarray, seed: int, reach: int) -> list[tuple[int, int, int]]:
    """Merge matches that follow each other on one diagonal: (first p, first q, words).

    Matches come sorted by (diagonal, p); two of them join if at most ``reach`` words apart.
    """
    order = np.lexsort((p, p - q))
    p, q = p[order], q[order]
    new = np.r_[True, (np.diff(p - q) != 0) | (np.diff(p) > reach)]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(p)] - 1
    return sorted(zip(p[first].tolist(), q[first].tolist(), (p[last] - p[first] + seed).tolist()))


def chains(parts: list[tuple[int, int, int]], seed: int) -> list[list[tuple[int, int, int]]]:
    """Split fragments into collinear chains, best first; every fragment is in one chain.

    score(j) = words(j) + max(0, score(i) - gap cost from i to j) over i that ends before j
    on both sides. The cost is linear in the skipped words, so a sweep over p with a prefix
    maximum over q finds the best i. Fragments may overlap by less than a seed.
    """
    if len(parts) == 1:
        return [parts]
    slack = seed - 1
    ends = [(p + n - slack, q + n - slack) for p, q, n in parts]
    ranks = {q: r for r, q in enumerate(sorted({e[1] for e in ends} | {part[1] for part in parts}))}
    tree, score, back = PrefixMax(len(ranks)), [0.0] * len(parts), [-1] * len(parts)
    events = sorted([(e[0], 0, i) for i, e in enumerate(ends)] + [(part[0], 1, i) for i, part in enumerate(parts)])
    for _, starts, i in events:
        p, q, n = parts[i]
        if starts:
            value, j = tree.get(ranks[q])
            gain = value - GAP_COST * (p + q)
            score[i], back[i] = (n + gain, j) if j >= 0 and gain > 0 else (n, -1)
        else:
            tree.put(ranks[ends[i][1]], score[i] + GAP_COST * sum(ends[i]), i)
    used, found = [False] * len(parts), []
    for i in sorted(range(len(parts)), key=lambda i: (-score[i], i)):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(parts[i])
            i = back[i]
        if chain:
            found.append(chain[::-1])
    return found


def safe_spans(
    owner: np.ndarray, p: np.ndarray, q: np.ndarray, width: np.ndarray, reach: int, similarity: float
) -> np.ndarray:
    """Rows (owner, diagonal, from, to): stretches of p that alignment with the owner keeps whole.

    ``width`` words agree at each match. Along one diagonal the words between matches are at
    most as many edits, so a stretch with few enough of them is alike whatever they are.
    """
    diagonal = p - q
    order = np.lexsort((p, diagonal, owner))
    owner, diagonal, p, width = owner[order], diagonal[order], p[order], width[order]
    group = np.cumsum(np.r_[True, (np.diff(owner) != 0) | (np.diff(diagonal) != 0)])
    stride = int((p + width).max()) + reach + 1
    start = p + group * stride
    end = np.maximum.accumulate(start + width)
    first = np.flatnonzero(np.r_[True, start[1:] > end[:-1]])
    found: list[list[int]] = []
    wrong = 0
    last = np.r_[first[1:], len(p)] - 1
    for i, lo, hi, g in zip(first.tolist(), start[first].tolist(), end[last].tolist(), group[first].tolist()):
        lo, hi = lo - g * stride, hi - g * stride
        if found and found[-1][0] == g:
            gap = lo - found[-1][3]
            if gap <= reach and wrong + gap <= (1 - similarity) * (hi - found[-1][2]):
                found[-1][3] = hi
                wrong += gap
                continue
        found.append([g, i, lo, hi])
        wrong = 0
    out = np.array(found, dtype=np.int64).reshape(-1, 4)
    return np.column_stack([owner[out[:, 1]], diagonal[out[:, 1]], out[:, 2:]])


def least_cover(spans: np.ndarray, wanted: list[tuple[int, int]]) -> list[int]:
    """Fewest of ``spans`` (rows from, to) that cover all ``wanted``; each wanted place is in one.

    From left to right: of the spans that begin in time, the one that reaches farthest.
    """
    order = np.lexsort((-spans[:, 1], spans[:, 0])).tolist()
    chosen, at, best = [], 0, -1
    for lo, hi in wanted:
        if best >= 0 and spans[best, 1] > lo:
            lo = int(spans[best, 1])
        while lo < hi:
            while at < len(order) and spans[order[at], 0] <= lo:
                if best < 0 or spans[order[at], 1] > spans[best, 1]:
                    best = order[at]
                at += 1
            if not chosen or chosen[-1] != best:
                chosen.append(best)
            lo = int(spans[best, 1])
    return chosen


def edits(a: str, b: str) -> int:
    """Edit distance, by bit-parallel columns of any length."""
    if not a or not b:
        return max(len(a), len(b))
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    every, top, distance = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    up, down = every, 0
    for c in b:
        match = masks.get(c, 0)
        diagonal = (((match & up) + up) ^ up) | match | down
        plus, minus = down | (every & ~(diagonal | up)), up & diagonal
        distance += bool(plus & top) - bool(minus & top)
        plus = (plus << 1 | 1) & every
        up, down = (minus << 1) & every | (every & ~(diagonal | plus)), plus & diagonal
    return distance


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def _equal_runs(a: str, b: str, least: int) -> list[tuple[int, int]]:
    """Runs of at least ``least`` positions at which two strings of one length agree."""
    if a == b:
        return [(0, len(a))]
    same = np.array(list(a)) == np.array(list(b))
    turns = np.flatnonzero(np.diff(np.r_[False, same, False].astype(np.int8))).reshape(-1, 2)
    return [(lo, hi) for lo, hi in turns.tolist() if hi - lo >= least]


def blocks(a: str, b: str, chain: list[tuple[int, int, int]], least: int) -> list[tuple[int, int, int]]:
    """(from in a, from in b, words) of the exact runs along a chain, in order on both sides."""
    found, at_a, at_b = [], 0, 0
    for p, q, n in chain:
        skip = max(at_a - p, at_b - q, 0)
        p, q, n = p + skip, q + skip, n - skip
        if n > 0:
            # What an overlap leaves of a seed still counts.
            found += [(p + lo, q + lo, hi - lo) for lo, hi in _equal_runs(a[p : p + n], b[q : q + n], min(least, n))]
            at_a, at_b = p + n, q + n
    return found


def alike_stretches(
    a: str, b: str, exact: list[tuple[int, int, int]], similarity: float
) -> list[tuple[int, int, int]]:
    """(first, last, edits) of the longest stretches of exact runs that are alike enough.

    A stretch is alike if its edits are at most 1 - similarity of its words on the longer
    side. None lies within another, but they may overlap; every exact run is in one.
    """
    if len(exact) < 2:
        return [(0, 0, 0)] * len(exact)
    p, q, n = np.array(exact).T
    wrong = [edits(a[p[i] + n[i] : p[i + 1]], b[q[i] + n[i] : q[i + 1]]) for i in range(len(n) - 1)]
    wrong = np.r_[0, np.cumsum(wrong, dtype=np.int64)].astype(np.int64)
    best = np.arange(len(n))
    for at in (p, q):
        # Words times the allowed share less the edits, up to the start and the end of each run.
        start, end = (1 - similarity) * at - wrong, (1 - similarity) * (at + n) - wrong
        ahead = np.maximum.accumulate(end[::-1])
        # The last run whose end is not below the start of run i.
        last = len(n) - 1 - np.searchsorted(ahead, start - 1e-9)
        best = np.maximum(best, last)
    found, reached = [], -1
    for i, last in enumerate(best.tolist()):
        if last > reached:
            found.append((i, last, int(wrong[last] - wrong[i])))
            reached = last
    return found


def extend(a: str, b: str) -> tuple[int, int, int]:
    """(words of a, words of b, edits) of the best common start, by a banded alignment.

    Agreeing words count 1, edits -1; of equal scores the longest start wins. Cells that are
    more than X_DROP below the best are not followed.
    """
    same = _common(a, b)
    a, b = a[same:], b[same:]
    if not a or not b:
        return same, same, 0
    top = (0, 0, 0, 0)  # score, words of a, words of b, edits
    # Per row: cells by place in b, as (score, edits).
    row = {j: (-j, j) for j in range(min(len(b), X_DROP) + 1)}
    for i, word in enumerate(a, 1):
        fresh: dict[int, tuple[int, int]] = {}
        floor = top[0] - X_DROP
        for j in range(min(row), min(max(row) + 1 + X_DROP, len(b)) + 1):
            best = None
            if j in row:
                score, wrong = row[j]
                best = (score - 1, wrong + 1)
            if j - 1 in row:
                score, wrong = row[j - 1]
                step = (score + 1, wrong) if b[j - 1] == word else (score - 1, wrong + 1)
                best = step if best is None or step[0] > best[0] else best
            if j - 1 in fresh and (best is None or fresh[j - 1][0] - 1 > best[0]):
                best = (fresh[j - 1][0] - 1, fresh[j - 1][1] + 1)
            if best is None:
                if j > max(row) + 1:
                    break
                continue
            if best[0] >= floor:
                fresh[j] = best
                if j and b[j - 1] == word and (best[0], i + j) >= (top[0], top[1] + top[2]):
                    top = (best[0], i, j, best[1])
        if not fresh:
            break
        row = fresh
    return same + top[1], same + top[2], top[3]


# Starts are extended side by side, so many pairs at once; diagonals followed to either side of the main one.
AT_ONCE, DIAGONALS = 4096, 16
# Score of a cell that is not followed; columns are numbered below RANK in the keys of running maxima.
DEAD, RANK = -(1 << 20), 1 << 6


def extend_all(pairs: list[tuple[str, str]]) -> list[tuple[int, int, int]]:
    """``extend`` of many pairs of strings.

    Rows of all pairs are computed together, a column per diagonal. A pair whose cells reach
    the outermost diagonals is extended by itself.
    """
    found: list[tuple[int, int, int]] = []
    for at in range(0, len(pairs), AT_ONCE):
        some = pairs[at : at + AT_ONCE]
        same = [_common(a, b) for a, b in some]
        rest = [(a[n:], b[n:]) for (a, b), n in zip(some, same)]
        open_ends = [i for i, (a, b) in enumerate(rest) if a and b]
        ends = [(n, n, 0) for n in same]
        for i, end in zip(open_ends, _extend_rows([rest[i] for i in open_ends])):
            n = same[i]
            ends[i] = (n + end[0], n + end[1], end[2]) if end else extend(*some[i])
        found += ends
    return found


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The letters of all texts, where each text begins and how long it is.

    Letters in front and behind let every diagonal read on both sides.
    """
    edge = "\0" * (2 * DIAGONALS + 2)
    size = np.array([len(t) for t in texts], dtype=np.int32)
    begin = (np.cumsum(size) - size + len(edge)).astype(np.int32)
    return np.frombuffer("".join([edge, *texts, edge]).encode("utf-32-le"), dtype="<u4"), begin, size


def _extend_rows(pairs: list[tuple[str, str]]) -> list[tuple[int, int, int] | None]:
    """(words of a, words of b, edits) per pair of filled strings; None where a band of DIAGONALS is too narrow."""
    out: list[tuple[int, int, int] | None] = [(0, 0, 0)] * len(pairs)
    if not pairs:
        return out
    letters_a, begin_a, size_a = _letters([a for a, _ in pairs])
    letters_b, begin_b, size_b = _letters([b for _, b in pairs])
    column = np.arange(2 * DIAGONALS + 1, dtype=np.int32)
    shift = column - DIAGONALS
    pair = np.arange(len(pairs))
    # Row 0: cells 0 to X_DROP of b, all inserted.
    inside = (shift >= 0) & (shift <= X_DROP) & (shift <= size_b[:, None])
    score = np.where(inside, -shift, DEAD).astype(np.int32)
    wrong = np.where(inside, shift, 0).astype(np.int32)
    # Score, words of a and b, edits.
    top = np.zeros((len(pairs), 4), dtype=np.int64)
    i = 0
    while len(pair):
        i += 1
        place = i + shift
        floor = top[:, 0] - X_DROP
        last = column[-1] - np.argmax(score[:, ::-1] > DEAD, axis=1)
        word = letters_a[begin_a + i - 1]
        within = place <= size_b[:, None]
        agrees = (letters_b.take(begin_b[:, None] + (place - 1)) == word[:, None]) & within
        if i <= DIAGONALS:
            within &= place >= 0
            agrees &= place >= 1
        # A word of a left out comes from the next diagonal, a pair of words from the same one.
        base, edit = np.full_like(score, DEAD), np.zeros_like(wrong)
        base[:, :-1], edit[:, :-1] = score[:, 1:] - 1, wrong[:, 1:] + 1
        step = np.where(agrees, score + 1, score - 1)
        better = step > base
        base, edit = np.where(better, step, base), np.where(better, np.where(agrees, wrong, wrong + 1), edit)
        base[~within] = DEAD
        # Words of b left out: the best cell before, less the distance; the nearest of equal ones.
        key = np.maximum.accumulate((base + column) * np.int32(RANK) + column, axis=1)
        source = key & (RANK - 1)
        score = key // RANK - column
        each = np.arange(len(pair))
        wrong = edit.take(source + (each * len(column))[:, None]) + (column - source)
        alive = (score >= floor[:, None]) & within & (column <= (last + X_DROP)[:, None])
        score = np.where(alive, score, DEAD)
        # The best agreeing cell, the longest of equal ones.
        rank = np.where(alive & agrees, score, DEAD) * RANK + column
        best = rank.argmax(axis=1)
        value, length = score[each, best], place[best]
        hit = (alive & agrees)[each, best]
        hit &= (value > top[:, 0]) | (value == top[:, 0]) & (i + length >= top[:, 1] + top[:, 2])
        top[hit] = np.column_stack([value, np.full(len(pair), i), length, wrong[each, best]])[hit]
        wide = alive[:, 0] | alive[:, -1]
        done = wide | ~alive.any(axis=1) | (size_a == i)
        if done.any():
            for k, end, narrow in zip(pair[done].tolist(), top[done, 1:].tolist(), wide[done].tolist()):
                out[k] = None if narrow else tuple(end)
            left = ~done
            pair, top, score, wrong = pair[left], top[left], score[left], wrong[left]
            begin_a, size_a, begin_b, size_b = begin_a[left], size_a[left], begin_b[left], size_b[left]
    return out


def align(
    a: str, b: str, chain: list[tuple[int, int, int]], least: int, similarity: float
) -> list[tuple[int, int, int, int, int]]:
    """The alignment of one pair of strings, as ``align_all`` finds it."""
    return align_all([(a, b, chain)], least, similarity)[0]


def align_all(
    pairs: list[tuple[str, str, list[tuple[int, int, int]]]], least: int, similarity: float
) -> list[list[tuple[int, int, int, int, int]]]:
    """Align pairs of word strings along chains: (a from, a to, b from, b to, edits) per stretch.

    A chain is cut where it is not alike: between exact runs the strings are compared, and
    the longest stretches that reach ``similarity`` are kept. Their ends are extended over
    edits as long as more words agree, or only as far as the words agree where the stretch
    would fall below ``similarity``. Stretches inside another one are left out.
    """
    cores, ends = [], []
    for number, (a, b, chain) in enumerate(pairs):
        exact = blocks(a, b, chain, least)
        for first, last, wrong in alike_stretches(a, b, exact, similarity):
            (p0, q0, _), (p1, q1, n1) = exact[first], exact[last]
            cores.append((number, p0, p1 + n1, q0, q1 + n1, wrong))
            ends += [(a[:p0][::-1], b[:q0][::-1]), (a[p1 + n1 :], b[q1 + n1 :])]
    plain = [(n, n, 0) for n in (_common(*end) for end in ends)]
    far = extend_all(ends)
    found: list[set[tuple[int, int, int, int, int]]] = [set() for _ in pairs]
    for at, (number, p0, p1, q0, q1, wrong) in enumerate(cores):
        before, after = 2 * at, 2 * at + 1
        # The longest choice that is alike enough; plain ends always are.
        options = []
        for (i, j, e), (k, l, f) in (
            (far[before], far[after]),
            (far[before], plain[after]),
            (plain[before], far[after]),
            (plain[before], plain[after]),
        ):
            span = (p0 - i, p1 + k, q0 - j, q1 + l, wrong + e + f)
            if span[4] <= (1 - similarity) * max(span[1] - span[0], span[3] - span[2]) + 1e-9:
                options.append(span)
        found[number].add(max(options, key=lambda s: s[1] - s[0]))
    return [_outermost(spans) for spans in found]


def _outermost(found: set[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    kept: list[tuple[int, int, int, int, int]] = []
    for s in sorted(found, key=lambda s: (s[0], -s[1], s[2], -s[3])):
        if not any(k[0] <= s[0] and s[1] <= k[1] and k[2] <= s[2] and s[3] <= k[3] for k in kept):
            kept.append(s)
    return kept
