from __future__ import annotations

import re

import numpy as np
import pytest
from brute import AWKWARD_SCHEMA, SF, WORD

from eventstrata.llm import superminhash as smh
from eventstrata.llm.queries import REGISTRY


def plain_set(text, width=4):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def plain_components(sets, percent=80):
    """Root of every set by an inverted index over all shingles and exact counts."""
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders: dict = {}
    for i, s in enumerate(sets):
        shared: dict = {}
        for x in s:
            for j in holders.setdefault(x, []):
                shared[j] = shared.get(j, 0) + 1
            holders[x].append(i)
        for j, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(sets))]


def expected(rows):
    """(doc_id, n, component_id) of every row, sorted; rows are (doc_id, text)."""
    sets = [plain_set(t) for _, t in rows]
    top = plain_components(sets)
    ids: dict = {}
    for (d, _), t in zip(rows, top):
        ids.setdefault(t, []).append(d)
    least = {t: min([d for d in ds if d is not None], default=None) for t, ds in ids.items()}
    out = [(d, len(s), least[t] if s else d) for (d, _), s, t in zip(rows, sets, top)]
    return sorted(out, key=str)


def result(found):
    rows = found.collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=str)


def test_query_equals_brute_force(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert result(REGISTRY["op12_minhash_near_dedup"](spark, SF)) == expected(rows)


def test_awkward_rows_and_empty_table(spark, awkward, nothing):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert result(smh.near_duplicates(awkward)) == expected(rows)
    assert smh.near_duplicates(nothing).collect() == []


def test_repeated_ids_with_other_texts_do_not_link(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    table = spark.createDataFrame([(1, a, "", 0), (2, b, "", 0), (2, a, "", 0)], AWKWARD_SCHEMA)
    assert result(smh.near_duplicates(table)) == [(1, 27, 1), (2, 27, 1), (2, 27, 2)]


def chain(rng, length, count, edits):
    """Each text is the one before it with a few words replaced: links only along the chain."""
    words = [f"w{i}" for i in range(length)]
    texts = []
    for n in range(count):
        texts.append(" ".join(words))
        for at in rng.choice(length, edits, replace=False):
            words[at] = f"x{n}_{at}"
    return texts


@pytest.mark.parametrize("how", [smh.MinHash(), smh.MinHash(tile=7, tile_shingles=1500)])
def test_families_near_the_threshold(spark, how):
    """Chains, stars and a dense family around 0.8, in one tile and in many."""
    rng = np.random.default_rng(1)
    texts = chain(rng, 120, 25, 3) + chain(rng, 200, 25, 5) + chain(rng, 100, 10, 1)
    base = [f"s{i}" for i in range(150)]
    for n in range(40):
        copy = list(base)
        for at in rng.choice(150, 1 + n % 6, replace=False):
            copy[at] = f"y{n}_{at}"
        texts.append(" ".join(copy))
    texts += texts[60:70]
    rows = [(int(d), t) for d, t in zip(rng.permutation(len(texts)), texts)]
    table = spark.createDataFrame([(d, t, "", 0) for d, t in rows], AWKWARD_SCHEMA)
    got, want = result(smh.near_duplicates(table, how)), expected(rows)
    assert got == want
    assert 10 < len({c for _, _, c in want}) < 80


def test_tiny_sets(spark):
    """Sets of at most three runs only link when they are equal; four of five do."""
    words = "one two three four five six seven eight nine ten".split()
    texts = [" ".join(words[:n]) for n in range(1, 10)] + ["ONE two", "one\ttwo\n", " "]
    rows = list(enumerate(texts))
    table = spark.createDataFrame([(d, t, "", 0) for d, t in rows], AWKWARD_SCHEMA)
    assert result(smh.near_duplicates(table)) == expected(rows)
    assert smh.may_differ(80) == 4 and smh.may_differ(50) == 1


def slow_signature(hashes, slots):
    """One element after the other, every step of its permutation."""
    least = [None] * slots
    for h in hashes:
        order = list(range(slots))
        for j in range(slots):
            drawn = int(smh.mix(np.array([h], dtype=np.uint64) + np.uint64((j + 1) * int(smh.STEP) & smh.ALL))[0])
            k = j + ((drawn & 0xFFFFFFFF) * (slots - j) >> 32)
            order[j], order[k] = order[k], order[j]
            rank = j << 32 | drawn >> 32
            if least[order[j]] is None or rank < least[order[j]]:
                least[order[j]] = rank
        assert sorted(order) == list(range(slots))
    return least


@pytest.mark.parametrize("sizes", [[1, 5, 40, 2], [3000], [17000, 4]])
def test_early_stop_gives_the_full_signature(sizes):
    rng = np.random.default_rng(len(sizes))
    hashes = rng.integers(0, 1 << 63, sum(sizes), dtype=np.uint64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    got = smh.signatures(hashes, owner, len(sizes), 12)
    for i in range(len(sizes)):
        if sizes[i] <= 3000:
            assert got[i].tolist() == slow_signature(hashes[owner == i], 12)
    assert (got >> np.uint64(32)).max() < 12


def test_signature_agreement_estimates_similarity():
    """Agreement is unbiased and spreads less than independent hashes would."""
    rng = np.random.default_rng(9)
    off = []
    for _ in range(200):
        pool = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
        sets = [pool[:125], pool[25:]]  # 100 of 150 shared
        ranks = smh.signatures(np.concatenate(sets), np.repeat([0, 1], 125), 2, 160)
        off.append((ranks[0] == ranks[1]).mean() - 100 / 150)
    independent = (2 / 3 * 1 / 3 / 160) ** 0.5
    assert abs(np.mean(off)) < 4 * independent / 200**0.5
    assert np.std(off) < 0.95 * independent
