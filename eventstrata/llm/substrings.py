"""Fuzzy repeated passages: shared seeds, collinear chains, alignment."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventstrata.llm.chaining import X_DROP, align_all, chains, fragments, least_cover, safe_spans
from eventstrata.llm.common import group_starts, numbers, text_bytes, whole_groups
from eventstrata.llm.textstats import window_hashes, word_hashes
from eventstrata.session import scratch_path, stage

# Words become one character each for alignment; the alphabet avoids surrogates.
ALPHABET, FIRST_CHARACTER = 0xD000, 0x100


@dataclass(frozen=True)
class Passages:
    """What counts as a repeated passage, in words."""

    seed: int = 5  # words per seed
    window: int = 8  # of so many neighbouring seeds the least hash is kept
    anchor: int = 16  # words per anchor: a seed too long for a common phrase
    anchor_window: int = 32  # of so many neighbouring anchors the least hash is kept
    least: int = 50  # shortest passage
    least_part: int = 25  # shortest chain that counts towards a passage
    similarity: float = 0.8  # least share of a chain's words that agree

    margin: int = 64  # words around a chain over which its ends may be extended
    reach: int = 80  # words between matches on one diagonal that a fragment bridges


def least_places(hashes: np.ndarray, span: int) -> np.ndarray:
    """Where the least of every ``span`` neighbouring hashes is, the first of equal ones."""
    at, step = np.arange(len(hashes)), 1

    def lesser(shift: int, count: int) -> np.ndarray:
        a, b = at[:count], at[shift : shift + count]
        return np.where(hashes[b] < hashes[a], b, a)

    while 2 * step <= span:
        at = lesser(step, len(at) - step)
        step *= 2
    return lesser(span - step, len(at) - span + step) if span > step else at


def least_of_windows(hashes: np.ndarray, first: np.ndarray, count: np.ndarray, window: int, width: int) -> np.ndarray:
    """Positions of the least of every ``window`` neighbouring hashes of ``width`` words of a text.

    ``first`` and ``count`` say which hashes are a text's. The choice depends only on the
    words nearby, so equal runs keep equal seeds. Of a run of overlapping equal seeds the
    first is kept.
    """
    chosen, begins = np.zeros(len(hashes), dtype=bool), np.zeros(len(hashes), dtype=bool)
    long = count >= window
    if long.any():
        chosen[least_places(hashes, window)[_ranges(first[long], count[long] - window + 1)]] = True
    for s, n in zip(first[~long & (count > 0)].tolist(), count[~long & (count > 0)].tolist()):
        chosen[s + hashes[s : s + n].argmin()] = True
    begins[first[count > 0]] = True
    at = np.flatnonzero(chosen)
    text = np.cumsum(begins)[at]
    new = (np.diff(hashes[at]) != 0) | (np.diff(at) > width) | (np.diff(text) != 0)
    return at[np.r_[True, new]] if len(at) else at


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers from each of ``first`` on, ``count`` of them."""
    return np.arange(count.sum()) + np.repeat(first - np.cumsum(count) + count, count)


def kept_seeds(words: np.ndarray, how: Passages, sizes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(positions, keys) of the seeds and anchors of texts with ``sizes`` words, one after the other.

    A key's lowest bit marks an anchor; positions are those in all the words.
    """
    sizes = np.array([len(words)]) if sizes is None else sizes
    first = np.cumsum(sizes) - sizes
    positions, keys = [], []
    for mark, width, window in ((0, how.seed, how.window), (1, how.anchor, how.anchor_window)):
        hashes = window_hashes(words, width)
        some = sizes >= width
        at = least_of_windows(hashes, first[some], sizes[some] - width + 1, window, width)
        positions.append(at)
        keys.append(hashes[at] & ~np.uint64(1) | np.uint64(mark))
    return np.concatenate(positions), np.concatenate(keys)


# A row's document: its id and, where rows of one id have several texts, a hash of its own.
DOC = ["doc", "sig"]
SEED = "seed long, doc long, sig long, pos int"


# Texts are hashed together until they have so many words.
WORDS_AT_ONCE = 1 << 17


def _hashed(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, number of words per row, hashes of all their words) of some rows at a time."""
    words, sizes, start = [], [], 0
    for at, text in enumerate(text_bytes(batch.column("text")), 1):
        split = (text or b"").split()
        words += split
        sizes.append(len(split))
        if len(words) >= WORDS_AT_ONCE or at == batch.num_rows:
            yield start, np.array(sizes, dtype=np.int64), word_hashes(words)
            words, sizes, start = [], [], at


def _rows_of(choose):
    """One row per (seed, position) of each document; ``choose`` finds them in the words of several texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, sizes, words in _hashed(batch):
                at, keys = choose(words, sizes)
                ends = np.cumsum(sizes)
                row = np.searchsorted(ends, at, side="right")
                pos = (at - (ends - sizes)[row]).astype(np.int32)
                doc, sig = (batch.column(c).take(pa.array(row + start)) for c in DOC)
                columns = [pa.array(keys.view(np.int64)), doc, sig, pa.array(pos)]
                yield pa.RecordBatch.from_arrays(columns, names=["seed", *DOC, "pos"])

    return run


def _seeds(how: Passages):
    return _rows_of(lambda words, sizes: kept_seeds(words, how, sizes))


# Slots for anchors that more than two places share; once they are full every run is joined.
SLOTS = 1 << 26


def crowded_runs(words: np.ndarray, bits: np.ndarray, how: Passages, sizes: np.ndarray) -> np.ndarray:
    """Starts of the runs of ``how.least`` words whose every sure anchor is marked in ``bits``.

    A run's sure anchors are the least of the anchor windows inside it, which every copy of
    the run keeps as well. If one of them is in two places only, its link is the run's only
    possible partner; the other runs are those returned. Texts of ``sizes`` words follow one another.
    """
    long = sizes >= how.least
    if not long.any():
        return np.zeros(0, dtype=np.int64)
    anchors = window_hashes(words, how.anchor)
    inside = how.least - how.anchor - how.anchor_window + 2
    slot = (anchors >> np.uint64(1)) % np.uint64(SLOTS)
    crowded = bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1
    marked = crowded[least_places(anchors, how.anchor_window)]
    starts = _ranges((np.cumsum(sizes) - sizes)[long], sizes[long] - how.least + 1)
    every = marked[starts] != 0
    for i in range(1, inside):
        every &= marked[starts + i] != 0
    return starts[every]


def _runs(how: Passages, bits: np.ndarray):
    """Hashes of the crowded runs, in the form of seeds."""

    def choose(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = crowded_runs(words, bits, how, sizes)
        return at, window_hashes(words, how.least, at)

    return _rows_of(choose)


LINKED = "seed long, doc long, sig long, pos int, other long, osig long, other_pos int, places int"


def _linked(seeds: DataFrame) -> DataFrame:
    """Every place of the seeds that two documents have, with the seed's first place.

    ``places`` is 1 or 2 or, for three and more, 3.
    """
    dealt = seeds.repartition("seed").sortWithinPartitions("seed", *DOC, "pos")
    return dealt.mapInArrow(_with_first, LINKED)


def _with_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places sorted by seed, document and position, with the first of their seed.

    Of a seed that goes on in the next batch only the first place is held back, and all its
    places as long as they are fewer than three or in one document.
    """
    names = [f.split()[0] for f in SEED.split(", ")]
    held = [np.zeros(0, dtype=np.int64) for _ in names]
    # The last seed's first place once some of its places are out.
    known: list[int] | None = None

    def out(rows: list[np.ndarray], first: np.ndarray, size: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
        """The groups of ``size`` places from ``first`` on whose documents differ."""
        several = (rows[1][first] != rows[1][last]) | (rows[2][first] != rows[2][last])
        first, size = first[several], size[several]
        at, of = _ranges(first, size), np.repeat(first, size)
        places = np.repeat(np.minimum(size, 3), size)
        columns = [*[r[at] for r in rows], *[r[of] for r in rows[1:]], places]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    schema = _arrow(LINKED)
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [np.r_[h, numbers(batch, c).astype(np.int64)] for h, c in zip(held, names)]
        if known:
            same = int(np.searchsorted(rows[0], known[0], side="right"))
            if same:
                columns = [*[r[:same] for r in rows], *[np.full(same, k) for k in known[1:]], np.full(same, 3)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
                rows = [r[same:] for r in rows]
        held = [r[:0] for r in rows]
        if not len(rows[0]):
            continue
        known = None
        first = np.flatnonzero(np.r_[True, rows[0][1:] != rows[0][:-1]])
        last = np.r_[first[1:], len(rows[0])] - 1
        s, e = int(first[-1]), int(last[-1])
        if e - s < 2 or (rows[1][s] == rows[1][e] and rows[2][s] == rows[2][e]):
            held = [r[s:] for r in rows]
            first, last = first[:-1], last[:-1]
        else:
            known = [int(r[s]) for r in rows]
        yield out(rows, first, last - first + 1, last)
    if len(held[0]):
        yield out(held, np.zeros(1, dtype=np.int64), np.array([len(held[0])]), np.array([len(held[0]) - 1]))


def _crowded(linked: DataFrame) -> np.ndarray | None:
    """One bit per slot of the anchors in three places or more; None without such anchors."""
    slot = F.pmod(F.shiftrightunsigned("seed", 1), F.lit(SLOTS))
    crowded = linked.where("seed % 2 <> 0 and places > 2").select(slot.alias("slot"))
    bit = F.expr("shiftleft(1L, cast(slot % 32 as int))")
    words = crowded.groupBy(F.expr("cast(slot div 32 as int)").alias("word")).agg(F.bit_or(bit).alias("bits")).toPandas()
    if not len(words):
        return None
    out = np.zeros(SLOTS // 32, dtype="<u4")
    out[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    return out.view(np.uint8)


PAIR = ["doc", "sig", "other", "osig"]
CHAINS = "doc long, sig long, other long, osig long, p array<int>, q array<int>, n array<int>, lo int, hi int, other_lo int, other_hi int"
OTHER = ["other", "osig", "other_lo", "other_hi", "other_codes"]
# Regions of words to fetch start and end at multiples of this, so that few differ.
GRID = 32


def needed(
    pair: np.ndarray, p: np.ndarray, q: np.ndarray, width: np.ndarray, lone: np.ndarray, how: Passages
) -> np.ndarray:
    """Which matches of one document are worth aligning, ``pair`` naming each match's owner.

    In a family of near copies each run of a document has an owner of its own, the first
    member with just this run, while few members share all its runs. Words that a run has
    are repeated words however they are found, so of the owners' safe spans the fewest that
    cover all runs are kept, and the runs inside them. Other owners with nothing outside
    these spans are left out, unless a lone anchor, one that only the two of them have,
    names them: it stands for runs that are not hashed.
    """
    run = width == how.least
    if not run.any():
        return ~run
    spans = safe_spans(pair, p, q, width, how.reach, how.similarity)
    spans = spans[spans[:, 3] - spans[:, 2] >= how.least]
    starts = np.unique(p[run])
    first = np.flatnonzero(np.r_[True, np.diff(starts) > how.least])
    wanted = zip(starts[first].tolist(), (starts[np.r_[first[1:], len(starts)] - 1] + how.least).tolist())
    chosen, inside = np.zeros(len(p), dtype=bool), np.zeros(len(p), dtype=bool)
    for i in least_cover(spans[:, 2:], list(wanted)):
        of, diagonal, lo, hi = spans[i]
        here = (p >= lo) & (p + width <= hi)
        inside |= here
        chosen |= here & (pair == of) & (p - q == diagonal)
    named = np.unique(pair[chosen | lone | ~inside & ~run])
    return chosen | ~run & np.isin(pair, named)


def _chains(how: Passages):
    schema = pa.schema(
        [(c, pa.int64()) for c in PAIR]
        + [(c, pa.list_(pa.int32())) for c in "pqn"]
        + [(c, pa.int32()) for c in ("lo", "hi", "other_lo", "other_hi")]
    )

    def region(first: int, stop: int) -> tuple[int, int]:
        lo = max(first - how.margin, 0) // GRID * GRID
        return lo, -(-(stop + how.margin) // GRID) * GRID

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, DOC):
            p, q = numbers(rows, "pos").astype(np.int64), numbers(rows, "other_pos").astype(np.int64)
            width, lone = numbers(rows, "width").astype(np.int64), numbers(rows, "lone")
            pair = np.zeros(rows.num_rows, dtype=np.int64)
            pair[group_starts(rows, PAIR)] = 1
            pair = np.cumsum(pair)
            docs = group_starts(rows, DOC)
            keep = [
                np.flatnonzero(needed(pair[s:e], p[s:e], q[s:e], width[s:e], lone[s:e], how)) + s
                for s, e in zip(docs.tolist(), [*docs[1:].tolist(), rows.num_rows])
            ]
            at = np.concatenate(keep)
            p, q, width, pair = p[at], q[at], width[at], pair[at]
            starts = np.flatnonzero(np.r_[True, np.diff(pair) != 0])
            stops = np.r_[starts[1:], len(at)]
            names = [numbers(rows, c)[at] for c in PAIR]
            anchored = width > how.seed
            # A passage has an anchor, two seeds or more, or a place whose surroundings were compared.
            many = (stops - starts > 1) | np.logical_or.reduceat(anchored | lone[at], starts)
            out = []
            for s, e in zip(starts[many].tolist(), stops[many].tolist()):
                # An anchor or run counts as the seeds at its two ends.
                ends = np.flatnonzero(anchored[s:e]) + s
                here = np.r_[p[s:e], p[ends] + width[ends] - how.seed]
                there = np.r_[q[s:e], q[ends] + width[ends] - how.seed]
                key = [int(n[s]) for n in names]
                for line in chains(fragments(here, there, how.seed, how.reach), how.seed):
                    (p0, q0, _), (p1, q1, n1) = line[0], line[-1]
                    pieces = [list(x) for x in zip(*line)]
                    out.append((*key, *pieces, *region(p0, p1 + n1), *region(q0, q1 + n1)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema
                )

    return run


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each wanted region as one character per word."""
    for batch in batches:
        row, lo, hi, codes = [], [], [], []
        wanted = batch.column("wanted").to_pylist()
        for at, (text, regions) in enumerate(zip(text_bytes(batch.column("text")), wanted)):
            hashes = word_hashes((text or b"").split())
            letters = (hashes % ALPHABET + FIRST_CHARACTER).astype("<u4").tobytes().decode("utf-32-le")
            for r in regions:
                row.append(at)
                lo.append(r["lo"])
                hi.append(r["hi"])
                codes.append(letters[r["lo"] : r["hi"]])
        ids = [batch.column(c).take(pa.array(row, pa.int64())) for c in DOC]
        yield pa.RecordBatch.from_arrays(
            [*ids, pa.array(lo, pa.int32()), pa.array(hi, pa.int32()), pa.array(codes, pa.string())],
            names=[*DOC, "lo", "hi", "codes"],
        )


ALIKE = (
    "doc_id long, sig long, start int, end int, match_doc_id long, match_start int, match_end int, similarity double"
)
FOUND = f"{ALIKE}, passage_start int, passage_end int"


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Unite spans that overlap or touch."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in schema.split(", "))])


def _aligned(how: Passages):
    """The alike stretches of each chain."""
    schema = _arrow(ALIKE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            rows = batch.to_pylist()
            pairs = []
            for r in rows:
                line = [(p - r["lo"], q - r["other_lo"], n) for p, q, n in zip(r["p"], r["q"], r["n"])]
                pairs.append((r["codes"], r["other_codes"], line))
            for r, stretches in zip(rows, align_all(pairs, how.seed, how.similarity)):
                at, other_at = r["lo"], r["other_lo"]
                for lo, hi, other_lo, other_hi, wrong in stretches:
                    alike = 1 - wrong / max(hi - lo, other_hi - other_lo)
                    if hi - lo >= how.least_part and alike >= how.similarity - 1e-9:
                        there = (r["other"], other_lo + other_at, other_hi + other_at)
                        out.append((r["doc"], r["sig"], lo + at, hi + at, *there, alike))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def _passages(how: Passages):
    """The stretches that lie in a passage, with the passage; one document's rows at a time."""
    schema = _arrow(FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["doc_id", "sig"]):
            starts = group_starts(table, ["doc_id", "sig"])
            rows = list(zip(*[c.to_pylist() for c in table.columns]))
            out = []
            for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(rows)]):
                found = sorted(set(rows[s:e]))
                runs = [run for run in merged([f[2:4] for f in found]) if run[1] - run[0] >= how.least]
                for f in found:
                    inside = next((run for run in runs if run[0] <= f[2] and f[3] <= run[1]), None)
                    if inside:
                        out.append((*f, *inside))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


# Words around a place become bins; a word that is not there has the bin behind the last one.
BINS = (1 << 16) - 1
# Pairs are first looked for with so few bins that a row per place and a column per bin can be multiplied.
COARSE = 512
# So many places of a seed are compared with so many others; more are dealt over several tiles.
TILE = 1 << 14
# So many of a tile's places are multiplied with its others at once, and so many pairs: all may be alike.
ROWS_AT_ONCE, CELLS_AT_ONCE = 512, 1 << 18
# Up to so many pairs of a tile are looked up one by one, more as a product of matrices.
FEW_PAIRS, PAIRS_AT_ONCE = 2048, 1 << 17
# Score of a cell that is not followed; ends are followed for so many pairs at once.
DEAD, ENDS_AT_ONCE = -30, 1 << 12
# From so many pairs of a seed on they are looked for by rare words: those that one of RARE rows has or fewer.
HOT_PAIRS, RARE, LEAST_RARE = 1 << 17, 16, 3
TILES = ["seed", "i", "j"]
OPEN = "seed long, doc long, sig long, pos int, places long, open boolean, run int, around binary"
COMPARED = "doc long, sig long, other long, osig long, pos int, other_pos int, width int, lone boolean"


def _slack(how: Passages) -> int:
    """By how many words two alike stretches of the least length can shift."""
    return int((1 - how.similarity) * how.least_part) + 1


def _width(how: Passages) -> int:
    """Words kept of a place's surroundings: all stretches of the least length around a seed, shifted or not."""
    return 2 * (how.least_part + _slack(how)) - how.seed


def surroundings(words: np.ndarray, sizes: np.ndarray, row: np.ndarray, pos: np.ndarray, anchor: np.ndarray, how: Passages) -> np.ndarray:
    """The bins of the words around each of the places ``pos`` of text ``row``, in the middle the seed or anchor itself.

    Texts of ``sizes`` words follow one another.
    """
    size = _width(how)
    # As many words that are not there before and behind each text.
    bins = np.full(len(words) + (len(sizes) + 1) * size, BINS, dtype=np.uint16)
    begin = np.cumsum(sizes) - sizes + (np.arange(len(sizes)) + 1) * size
    bins[_ranges(begin, sizes)] = words % np.uint64(BINS)
    first = begin[row] + pos - np.where(anchor, (size - how.anchor) // 2, (size - how.seed) // 2)
    return bins[first[:, None] + np.arange(size)]


def periodic_runs(words: np.ndarray, sizes: np.ndarray, row: np.ndarray, pos: np.ndarray, anchor: np.ndarray, how: Passages) -> np.ndarray:
    """How many words from each of the places ``pos`` of text ``row`` go on with the period of its seed or anchor.

    Of overlapping equal seeds only the first is kept, so this is all that tells how long a
    run of one word or phrase is. Seeds that do not overlap an equal one have their own words only.
    """
    runs = np.where(anchor, how.anchor, how.seed)
    ends = np.cumsum(sizes)
    at, stop = (ends - sizes)[row] + pos, ends[row]
    for long, width in ((False, how.seed), (True, how.anchor)):
        rest = np.flatnonzero(anchor == long)
        hashes = window_hashes(words, width) if len(rest) else words
        for period in range(1, width + 1):
            rest = rest[at[rest] + period + width <= stop[rest]]
            same = hashes[at[rest]] == hashes[at[rest] + period]
            if same.any():
                differ = np.flatnonzero(np.r_[words[period:] != words[:-period], True])
                these = rest[same]
                until = differ[np.searchsorted(differ, at[these])] + period
                runs[these] = np.minimum(until, stop[these]) - at[these]
                rest = rest[~same]
    return runs


def _surroundings(how: Passages):
    """A row per wanted place with what stands around it."""
    size = 2 * _width(how)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start, sizes, words in _hashed(whole):
                batch = whole.slice(start, len(sizes))
                wanted = batch.column("wanted")
                owner = np.repeat(np.arange(batch.num_rows), wanted.value_lengths().to_numpy(zero_copy_only=False))
                if not len(owner):
                    continue
                fields = wanted.flatten()
                seed, at = (fields.field(c) for c in ("seed", "pos"))
                where = words, sizes, owner, at.to_numpy(), seed.to_numpy() % 2 != 0, how
                ends = np.arange(len(owner) + 1, dtype=np.int32) * size
                data = surroundings(*where).astype("<u2").tobytes()
                around = pa.Array.from_buffers(pa.binary(), len(owner), [None, pa.py_buffer(ends), pa.py_buffer(data)])
                ids = [batch.column(c).take(pa.array(owner)) for c in DOC]
                more = [fields.field(c) for c in ("places", "open")]
                columns = [seed, *ids, at, *more, pa.array(periodic_runs(*where), pa.int32()), around]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in OPEN.split(", ")])

    return run


def rare_pairs(
    bins: np.ndarray, left: np.ndarray, right: np.ndarray, rank: np.ndarray, how: Passages
) -> tuple[Iterator[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Pairs that may have an alike stretch, found by the words that few right rows have; and the left rows left to others.

    A stretch of the least length has at most as many words as it needs in common among those
    that many right rows have (a common sentence, say), so the rest are words that few have: those are
    looked up in lists of rows. Left rows whose stretches need fewer than LEAST_RARE of them are returned.
    """
    slack, length = _slack(how), how.least_part
    least = int(np.ceil(how.similarity * length - 1e-9))
    words = np.sort(bins[right], axis=1)
    first = np.c_[np.ones(len(words), dtype=bool), words[:, 1:] != words[:, :-1]] & (words != BINS)
    holder, word = np.nonzero(first)[0], words[first]
    order = np.argsort(word, kind="stable")
    holder = holder[order]
    size = np.bincount(word, minlength=BINS + 1)
    start = np.cumsum(size) - size
    inner = bins[left, slack : bins.shape[1] - slack]
    frequent = size[inner] * RARE > len(right)
    total = np.zeros((len(left), inner.shape[1] + 1), dtype=np.int16)
    np.cumsum(frequent, axis=1, out=total[:, 1:])
    lacking = least - (total[:, length:] - total[:, :-length]).max(axis=1)
    few = lacking >= LEAST_RARE

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        rows, step = np.flatnonzero(few), max(1, CELLS_AT_ONCE // len(right))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            of, place = np.nonzero(~frequent[some])
            rare = inner[some[of], place]
            cells = np.repeat(of * len(right), size[rare]) + holder[_ranges(start[rare], size[rare])]
            common = np.bincount(cells, minlength=len(some) * len(right)).reshape(len(some), -1)
            x, y = np.nonzero(common >= lacking[some][:, None])
            x, y = left[some[x]], right[y]
            earlier = rank[y] < rank[x]
            yield x[earlier], y[earlier]

    return pairs(), left[~few]


def alike_pairs(
    bins: np.ndarray,
    group: np.ndarray,
    left: np.ndarray,
    right: np.ndarray,
    slack: int,
    least: int,
    rank: np.ndarray | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group, from ``left`` and ``right``, with ``least`` words in common or more.

    Counted are the words of the left row, without ``slack`` at its two ends, whose bin the
    right row has: never fewer than an alignment of the two can match. Every pair is looked
    at, or with ``rank``, by which left and right rows of a group are sorted, every pair whose right row ranks
    lower; memory is one block of them. All pairs of a left row come together.
    """
    coarse = np.where(bins == BINS, COARSE, bins % COARSE).astype(np.int64)
    inner = coarse[:, slack : bins.shape[1] - slack]
    there = np.zeros((len(bins), COARSE + 1), dtype=bool)
    there[np.arange(len(bins))[:, None], coarse] = True
    there[:, COARSE] = False
    n = int(group[-1]) + 1
    n_left, n_right = np.bincount(group[left], minlength=n), np.bincount(group[right], minlength=n)
    from_left, from_right = np.cumsum(n_left) - n_left, np.cumsum(n_right) - n_right
    many = n_left * n_right > FEW_PAIRS
    for g in np.flatnonzero(many).tolist():
        b = right[from_right[g] : from_right[g] + n_right[g]]
        theirs = np.ascontiguousarray(there[b, :COARSE].T, dtype=np.float32)
        step = min(TILE, ROWS_AT_ONCE, max(1, CELLS_AT_ONCE // max(len(b), 1)))
        for at in range(from_left[g], from_left[g] + n_left[g], step):
            a = left[at : min(at + step, from_left[g] + n_left[g])]
            # No right row from here on ranks below any of these left rows.
            stop = len(b) if rank is None else int(np.searchsorted(rank[b], rank[a[-1]]))
            cells = inner[a] + np.arange(len(a))[:, None] * (COARSE + 1)
            ours = np.bincount(cells.ravel(), minlength=len(a) * (COARSE + 1)).reshape(len(a), -1)[:, :COARSE]
            common = np.flatnonzero(ours.astype(np.float32) @ theirs[:, :stop] >= least)
            x, y = a[common // max(stop, 1)], b[common % max(stop, 1)]
            if rank is not None:
                earlier = rank[y] < rank[x]
                x, y = x[earlier], y[earlier]
            yield x, y
    rows = left[~many[group[left]]]
    per_row = n_right[group[rows]]
    block = np.cumsum(per_row) // PAIRS_AT_ONCE
    for k in np.unique(block).tolist():
        some = rows[block == k]
        count = n_right[group[some]]
        a = np.repeat(some, count)
        skip = np.repeat(np.cumsum(count) - count, count)
        b = right[np.repeat(from_right[group[some]], count) + np.arange(len(a)) - skip]
        if rank is not None:
            earlier = rank[b] < rank[a]
            a, b = a[earlier], b[earlier]
        common = there[b[:, None], inner[a]].sum(axis=1)
        yield a[common >= least], b[common >= least]


def alike_around(bins: np.ndarray, a: np.ndarray, b: np.ndarray, how: Passages) -> np.ndarray:
    """Which pairs of rows have a stretch of the least length with enough words in common.

    A word of the left row counts if the right row has it where it stands or shifted by up
    to the slack, so again never fewer are counted than an alignment can match.
    """
    slack, length = _slack(how), how.least_part
    size = bins.shape[1] - 2 * slack
    least = int(np.ceil(how.similarity * length - 1e-9))
    out = np.zeros(len(a), dtype=bool)
    for at in range(0, len(a), 1 << 15):
        ours, theirs = bins[a[at : at + (1 << 15)], slack : slack + size], bins[b[at : at + (1 << 15)]]
        hit = np.zeros(ours.shape, dtype=bool)
        for shift in range(2 * slack + 1):
            hit |= ours == theirs[:, shift : shift + size]
        hit &= ours != BINS
        total = np.zeros((len(ours), size + 1), dtype=np.int16)
        np.cumsum(hit, axis=1, out=total[:, 1:])
        out[at : at + len(ours)] = (total[:, length:] - total[:, :-length] >= least).any(axis=1)
    return out


def reach(ours: np.ndarray, theirs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(score, words of ours, words of theirs, whether more may follow) of the best common starts of pairs of rows.

    Scored as the ends of stretches are: agreeing words count 1, edits -1, of equal scores
    a longer one wins, and cells of more than X_DROP below the best are not followed. More
    may follow where a cell at the rows' end is still followed.
    """
    n, size = ours.shape
    shift = np.arange(-X_DROP, X_DROP + 1, dtype=np.int16)[:, None]
    a = np.ascontiguousarray(ours.T)
    known = a != BINS
    b = np.full((size + 2 * X_DROP, n), BINS, dtype=theirs.dtype)
    b[X_DROP : X_DROP + size] = theirs.T
    score = np.repeat(np.where(shift >= 0, -shift, DEAD).astype(np.int16), n, axis=1)
    # Score and diagonal in one number.
    top, words = np.full(n, X_DROP, dtype=np.int16), np.zeros(n, dtype=np.int16)
    for i in range(size):
        step = score + np.where((b[i : i + len(shift)] == a[i]) & known[i], np.int16(1), np.int16(-1))
        # A word of ours left out comes from the next diagonal, words of theirs from those before.
        np.maximum(step[:-1], score[1:] - np.int16(1), out=step[:-1])
        for d in range(1, len(shift)):
            np.maximum(step[d], step[d - 1] - np.int16(1), out=step[d])
        score = np.where(step >= (top >> 5) - np.int16(X_DROP), step, np.int16(DEAD))
        best = ((score << 5) + (shift + np.int16(X_DROP))).max(axis=0)
        longer = (best >> 5) >= (top >> 5)
        top, words = np.where(longer, best, top), np.where(longer, np.int16(i + 1), words)
    return top >> 5, words, words + (top & 31) - X_DROP, (score > DEAD).any(axis=0)


def farthest(
    bins: np.ndarray, a: np.ndarray, b: np.ndarray, width: int, run: np.ndarray, rank: np.ndarray, how: Passages
) -> np.ndarray:
    """Which pairs of rows to align so that all words that a left row shares around its seed are found.

    ``width`` words agree in the middle. From there a pair's stretch is followed to both ends, as
    far as the surroundings show, or as far as ``run`` says that both repeat it. Stretches of one left row all hold its seed, so the one that
    reaches farthest before and the one that reaches farthest behind cover all of them; the
    one that agrees best is kept as well. Of equal ones that of the lowest ``rank`` is kept,
    so places of one document name the same owner. Pairs that end on both sides before they
    have as many words in common as an alike stretch of the least length has up to its best ends are
    none: what is cut off there holds no more agreeing words than edits.
    """
    first = (bins.shape[1] - width) // 2
    sides = []
    for part in (slice(first - 1, None, -1), slice(first + width, None)):
        ends = []
        for at in range(0, len(a), ENDS_AT_ONCE):
            x, y = (bins[side[at : at + ENDS_AT_ONCE], part] for side in (a, b))
            plain = np.c_[(x != y) | (x == BINS), np.ones(len(x), dtype=bool)].argmax(axis=1)
            ends.append((*reach(x, y), plain))
        value, words, other, more, plain = (np.concatenate(x).astype(np.int64) for x in zip(*ends))
        sides.append(((value, words, other), (plain, plain, plain), more))
    (far, near, more), (far_on, near_on, more_on) = sides
    repeated = np.minimum(run[a], run[b]) - width
    longer = (repeated > far_on[1]) & (near_on[1] == bins.shape[1] - first - width)
    far_on, near_on = (tuple(np.where(longer, repeated, x) for x in side) for side in (far_on, near_on))
    share = 1 - how.similarity
    before, behind = np.full(len(a), -1), np.full(len(a), -1)
    for left, right in ((near, near_on), (near, far_on), (far, near_on), (far, far_on)):
        # Never more edits than there are: a replaced word counts for two words and a score of two less.
        wrong = (left[1] + left[2] - 2 * left[0] + right[1] + right[2] - 2 * right[0] + 3) // 4
        length = np.maximum(left[1] + right[1], left[2] + right[2]) + width
        better = (wrong <= share * length + 1e-9) & (left[1] + right[1] > before + behind)
        before, behind = np.where(better, left[1], before), np.where(better, right[1], behind)
    agree = [v + (w + o - 2 * v) // 3 for v, w, o in (far, far_on)]
    certain = int(np.ceil(how.similarity * how.least_part - 1e-9))
    possible = (more | more_on).astype(bool) | (width + agree[0] + agree[1] >= 2 * certain - how.least_part)
    whole = before + behind + width >= how.least_part
    value = far[0] + far_on[0]
    kept = np.zeros(len(a), dtype=bool)
    some = np.flatnonzero(possible)
    for order in ((behind, before), (before, behind), (before + behind, value)):
        keys = (rank[b], -value, *[-o for o in order], ~whole, a)
        at = some[np.lexsort([k[some] for k in keys])]
        kept[at[np.r_[True, np.diff(a[at]) != 0]] if len(at) else at] = True
    return kept


def _compared(how: Passages):
    """Matches of open places with the places of earlier documents that have alike surroundings."""
    schema = pa.schema([*_arrow(COMPARED.rsplit(", ", 1)[0]), ("lone", pa.bool_())])
    least = int(np.ceil(how.similarity * how.least_part - 1e-9))
    size = _width(how)

    def chosen(bins: np.ndarray, pairs: list, anchor: np.ndarray, run: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = (np.concatenate(side) for side in zip(*pairs))
        close = alike_around(bins, a, b, how)
        a, b = a[close], b[close]
        kept = np.zeros(len(a), dtype=bool)
        for long, width in ((False, how.seed), (True, how.anchor)):
            these = np.flatnonzero(anchor[a] == long)
            if len(these):
                kept[these] = farthest(bins, a[these], b[these], width, run, rank, how)
        return a[kept], b[kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, TILES):
            bins = np.frombuffer(b"".join(table.column("around").to_pylist()), dtype="<u2").reshape(-1, size)
            first = np.zeros(table.num_rows, dtype=np.int64)
            first[group_starts(table, TILES)] = 1
            group = np.cumsum(first) - 1
            seed, doc, sig, pos, i, j, block, runs, is_open = (
                numbers(table, c) for c in ("seed", "doc", "sig", "pos", "i", "j", "block", "run", "open")
            )
            # Texts in their order; places of one text rank alike.
            order = np.lexsort((sig, doc))
            new = (np.diff(doc[order]) != 0) | (np.diff(sig[order]) != 0)
            rank = np.empty(len(order), dtype=np.int64)
            rank[order] = np.cumsum(np.r_[False, new])
            order = np.lexsort((pos, rank, group))
            left, right = order[(is_open & (i == block))[order]], order[(j == block)[order]]
            if not len(left) or not len(right):
                continue
            pairs, held = [], 0
            found = []
            hot = np.bincount(group[left], minlength=group[-1] + 1) * np.bincount(group[right], minlength=group[-1] + 1)
            for g in np.flatnonzero(hot > HOT_PAIRS).tolist():
                some, rest = rare_pairs(bins, left[group[left] == g], right[group[right] == g], rank, how)
                found.append(some)
                left = np.r_[left[group[left] < g], rest, left[group[left] > g]]
            if len(left):
                found.append(alike_pairs(bins, group, left, right, _slack(how), least, rank))
            for some in chain(*found, [None]):
                if some is not None:
                    pairs.append(some)
                    held += len(some[0])
                if not held or some is not None and held < PAIRS_AT_ONCE:
                    continue
                a, b = chosen(bins, pairs, seed % 2 != 0, runs, rank)
                pairs, held = [], 0
                if len(a):
                    width = np.where(seed[a] % 2 != 0, how.anchor, how.seed)
                    columns = [doc[a], sig[a], doc[b], sig[b], pos[a], pos[b], width, np.ones(len(a), dtype=bool)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _rest(texts: DataFrame, linked: DataFrame, found: DataFrame, how: Passages) -> DataFrame:
    """Matches with all further places of the seeds that are linked to their first place only.

    Left out are places inside a passage already found, and seeds in two places, whose link
    is the only one there is. An open place is compared with every place of its seed in
    earlier documents; a match is one whose surroundings have a stretch of ``how.least_part``
    words with as many in common as an alike stretch of that length needs. Comparing is quadratic in the open places of a seed, in tiles
    that tasks share; of a place's matches only those of its farthest reaching owners are returned.
    """
    covers = found.select(F.col("doc_id").alias("doc"), "sig", "passage_start", "passage_end").distinct()
    covers = covers.groupBy(*DOC).agg(F.collect_list(F.struct("passage_start", "passage_end")).alias("covers"))
    inside = F.expr(
        f"exists(covers, c -> c.passage_start <= pos and pos + if(seed % 2 <> 0, {how.anchor}, {how.seed}) <= c.passage_end)"
    )
    crowded = linked.where("places > 2").join(covers.hint("merge"), DOC, "left")
    later = F.expr("doc <> other or sig <> osig")
    flagged = crowded.select("seed", *DOC, "pos", (later & ~F.coalesce(inside, F.lit(False))).alias("open"))
    asked = flagged.groupBy("seed").agg(F.count("*").alias("places"), F.max("open").alias("any")).where("any").drop("any")
    wanted = stage(flagged.join(asked.hint("merge"), "seed"), scratch_path(texts.sparkSession, "wanted"))
    by_doc = wanted.groupBy(*DOC).agg(F.collect_set(F.struct("seed", "pos", "places", "open")).alias("wanted"))
    one_text = texts.join(by_doc.hint("merge"), DOC).select(*DOC, "text", "wanted")
    places = one_text.mapInArrow(_surroundings(how), OPEN)
    blocks = F.ceil(F.col("places") / TILE).cast("int")
    places = places.withColumn("blocks", blocks).withColumn("block", F.expr("cast(pmod(xxhash64(doc, sig, pos), blocks) as int)"))
    tiles = F.expr(
        "array_union(if(open, transform(sequence(0, blocks - 1), x -> struct(block as i, x as j)), array()), "
        "transform(sequence(0, blocks - 1), x -> struct(x as i, block as j)))"
    )
    dealt = places.select("seed", *DOC, "pos", "open", "block", "run", "around", F.explode(tiles).alias("tile"))
    dealt = dealt.select("*", "tile.i", "tile.j").drop("tile").repartition(*TILES).sortWithinPartitions(*TILES)
    owners = dealt.mapInArrow(_compared(how), COMPARED)
    # Other places that the two documents share nearby belong to the same chain.
    near = owners.select(*PAIR, F.col("pos").alias("p"), F.col("other_pos").alias("q")).distinct()
    own = wanted.where("open").select("seed", *DOC, "pos")
    close = F.abs(F.col("pos") - F.col("p")) <= how.least + how.reach
    near = near.join(own.hint("merge"), DOC).where(close)
    theirs = wanted.select("seed", *[F.col(a).alias(b) for a, b in zip([*DOC, "pos"], ["other", "osig", "other_pos"])])
    shifted = F.col("pos") - F.col("other_pos") - F.col("p") + F.col("q")
    near = near.join(theirs.hint("merge"), ["other", "osig", "seed"]).where(F.abs(shifted) <= how.reach)
    width = F.when(F.col("seed") % 2 != 0, how.anchor).otherwise(how.seed)
    return near.select(*PAIR, "pos", "other_pos", width.alias("width"), F.lit(True).alias("lone")).distinct()


def repeated_passages(documents: DataFrame, how: Passages = Passages()) -> DataFrame:
    """Passages that a document shares with one of a smaller doc_id, exact or fuzzy.

    One row per aligned chain, or per alike stretch of a chain that is not alike as a whole: doc_id, start, end (word offsets, end exclusive),
    match_doc_id, match_start, match_end, similarity, and the passage it belongs to
    (passage_start, passage_end): overlapping chains of a document unite, and a passage has
    at least ``how.least`` words. Each seed is linked to its first place first, so a
    passage in a third of all documents gives one row per document, not all pairs; the
    first document appears as match_doc_id. What is not inside a passage then is compared with
    all further places of its seeds, so a fuzzy passage whose seeds all occur in earlier
    documents of their own is found as well. Short seeds are often phrases that some earlier
    document has as well, the more so the larger the corpus; anchors are longer, and an
    exact run of anchor + anchor_window - 1 words always has one. Where three places or more
    share a run's anchors, their first place need not hold the whole run: every such run of
    ``how.least`` words is hashed whole and linked to the first place that has all of it, so
    every exact repeat of that length meets a true owner. Repeats inside one document do not
    count.

    Rows that repeat a doc_id and its text are one document; rows of one doc_id with other
    texts are documents of their own, one of them the earlier one. Rows with a null doc_id and null or
    wordless texts take no part; other columns are not read; an empty table gives an empty
    result. Texts of any length are taken whole.
    """
    return _found(documents, _signature(documents), how).drop("sig")


def _signature(documents: DataFrame) -> Column:
    """Tells apart the texts of one doc_id; a constant in tables where no doc_id has several."""
    text = F.xxhash64("text")
    several = documents.groupBy("doc_id").agg(F.min(text).alias("a"), F.max(text).alias("b")).where("a <> b")
    return F.lit(0).cast("long") if several.isEmpty() else text


def _found(documents: DataFrame, signature: Column, how: Passages) -> DataFrame:
    """The passages with their documents' signatures."""
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("long").alias("doc"), signature.alias("sig"), "text")
    texts = texts.where("doc is not null")
    seeds = texts.where("text is not null").mapInArrow(_seeds(how), SEED)
    linked = stage(_linked(seeds), scratch_path(spark, "linked"))

    def links(linked: DataFrame, width: Column) -> DataFrame:
        lone = (F.col("seed") % 2 != 0) & (F.col("places") == 2)
        others = linked.where("doc <> other or sig <> osig")
        return others.select(*PAIR, "pos", "other_pos", width.alias("width"), lone.alias("lone"))

    matches = links(linked, F.when(F.col("seed") % 2 != 0, how.anchor).otherwise(how.seed))
    bits = _crowded(linked)
    if bits is not None:
        runs = texts.where("text is not null").mapInArrow(_runs(how, bits), SEED)
        matches = matches.unionByName(links(_linked(runs), F.lit(how.least)))
    alike = stage(_alike(texts, matches, DOC, how), scratch_path(spark, "alike"))

    def passages(alike: DataFrame) -> DataFrame:
        key = ["doc_id", "sig"]
        return alike.repartition(*key).sortWithinPartitions(*key).mapInArrow(_passages(how), FOUND)

    rest = _alike(texts, _rest(texts, linked, passages(alike), how), PAIR, how)
    return passages(alike.unionByName(rest))


def _alike(texts: DataFrame, matches: DataFrame, whole: list[str], how: Passages) -> DataFrame:
    """The alike stretches of the matches' chains; matches of equal ``whole`` are seen together."""
    spark = texts.sparkSession
    dealt = matches.repartition(*whole).sortWithinPartitions(*PAIR, "pos", "other_pos")
    chained = stage(dealt.mapInArrow(_chains(how), CHAINS), scratch_path(spark, "chains"))

    def as_other(rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(a).alias(b) for a, b in zip([*DOC, "lo", "hi", "codes"], OTHER)])

    theirs = [F.col(a).alias(b) for a, b in zip(OTHER, [*DOC, "lo", "hi"])]
    wanted = chained.select(*DOC, "lo", "hi").unionByName(chained.select(*theirs))
    by_doc = wanted.distinct().groupBy(*DOC).agg(F.collect_list(F.struct("lo", "hi")).alias("wanted"))
    one_text = texts.join(by_doc.hint("merge"), DOC).select(*DOC, "text", "wanted")
    regions = one_text.mapInArrow(_codes, "doc long, sig long, lo int, hi int, codes string")
    # One row per region before it is written: the joins below then split hot regions.
    regions = stage(regions.dropDuplicates([*DOC, "lo", "hi"]), scratch_path(spark, "regions"))
    both = chained.join(as_other(regions), OTHER[:4]).join(regions, [*DOC, "lo", "hi"])
    return both.repartition(*PAIR).mapInArrow(_aligned(how), ALIKE)


def without_passages(text: Column, spans: Column) -> Column:
    """A text column without its spans of words; null texts stay null."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, found in zip(text_bytes(texts), spans.to_pylist()):
            if text is not None:
                text = cut_words(text, merged([(s["start"], s["end"]) for s in found]))
            out.append(text)
        return pa.array(out, pa.binary()).cast(pa.string())

    return cut(text, spans)


def cut_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """A text without the words of ``spans`` and the white space that follows them."""
    words = text.split()
    begin, at = [], 0
    for word in words:
        at = text.index(word, at)
        begin.append(at)
        at += len(word)
    begin.append(len(text))
    out, at = [], 0
    for lo, hi in spans:
        out.append(text[at : begin[lo]])
        at = begin[min(hi, len(words))]
    return b"".join([*out, text[at:]])


def drop_passages(documents: DataFrame, how: Passages = Passages()) -> DataFrame:
    """The documents without their repeated passages; the first document keeps its own.

    Rows of which nothing but white space is left are dropped; rows without a passage stay
    as they are. n_chars follows the text if there is such a column.
    """
    signature = _signature(documents)
    spans = _found(documents, signature, how).select(
        "doc_id",
        F.col("sig").alias("_sig"),
        F.struct(F.col("passage_start").alias("start"), F.col("passage_end").alias("end")).alias("s"),
    )
    per_doc = spans.groupBy("doc_id", "_sig").agg(F.collect_set("s").alias("_spans"))
    per_doc = stage(per_doc, scratch_path(documents.sparkSession, "passages"))
    has = F.col("_spans").isNotNull()
    signed = documents.withColumn("_sig", signature)
    joined = signed.join(per_doc.hint("merge"), ["doc_id", "_sig"], "left").select(*documents.columns, "_spans")
    # Only texts with passages are sent to Python.
    joined = joined.withColumn("_left", without_passages(F.when(has, F.col("text")), F.col("_spans")))
    joined = joined.where(~has | F.col("_left").rlike(r"[^ \t-\r]"))
    changed = {"text": F.col("_left"), "n_chars": F.length("_left").cast("long")}
    return joined.select(
        *[
            F.when(has, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
            for c in documents.columns
        ]
    )
