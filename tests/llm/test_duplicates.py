from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from brute import AWKWARD, SHARED, components, repeated_exactly, simhash
from hypothesis import given, settings
from hypothesis import strategies as st

from eventstrata.llm import chaining, graph, simhash as sim, substrings
from eventstrata.llm.gray_index import GrayIndex, gray_rank


def test_fingerprints_and_components(documents, texts):
    rows = sim.near_duplicates(documents).collect()
    codes = {r["doc_id"]: r["code"] % (1 << 64) for r in rows}
    assert codes == {d: simhash(t, 3) for d, t in texts.items()}
    ids = sorted(codes)
    classes = components([codes[d] for d in ids], 3)
    least = {}
    for d, c in zip(ids, classes):
        least.setdefault(c, d)
    assert {r["doc_id"]: r["component_id"] for r in rows} == {d: least[c] for d, c in zip(ids, classes)}


def test_one_of_each_stays(documents, awkward, nothing):
    found = sim.near_duplicates(documents)
    kept = sim.keep_one_each(documents)
    assert kept.columns == documents.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({r["component_id"] for r in found.collect()})
    rows = sim.keep_one_each(awkward).collect()
    texts = {r["text"] for r in rows}
    assert len(rows) == len(texts) and SHARED in texts
    assert sim.near_duplicates(awkward).count() == len(AWKWARD)
    assert sim.near_duplicates(nothing).count() == 0 and sim.keep_one_each(nothing).count() == 0


def test_ids_that_repeat_with_other_texts(spark):
    a, b = "some words " * 9, "quite different other ones"
    table = spark.createDataFrame([(5, a), (5, b), (9, b), (None, "alone here"), (None, "alone here")], "doc_id long, text string")
    kept = sim.keep_one_each(table).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept) == sorted([("5", a), ("5", b), ("None", "alone here")])


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 300), st.integers(1, 5))
def test_gray_index_finds_all_pairs(seed, n, groups):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(4)]
    codes = [rng.choice(centres) ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) for _ in range(n)]
    codes = np.array([c % (1 << 64) for c in codes], dtype=np.uint64)
    group = np.sort(np.array([rng.randrange(groups) for _ in range(n)]))
    order = np.lexsort((gray_rank(codes), group))
    codes = codes[order]
    got = {(int(a), int(b)) for q, f in GrayIndex(codes, group).search(3) for a, b in zip(q, f)}
    want = {
        (i, j)
        for i in range(n)
        for j in range(i + 1, n)
        if group[i] == group[j] and int(codes[i] ^ codes[j]).bit_count() <= 3
    }
    assert got == want


def test_hot_band_value_is_tiled(spark, monkeypatch):
    monkeypatch.setattr(sim, "TILE", 50)
    rng = random.Random(4)
    codes = sorted({0xABCD << 48 | 1 << rng.randrange(40) | 1 << rng.randrange(40) for _ in range(400)})
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    found = sim.hamming_components(spark.createDataFrame([(c,) for c in signed], "code long"), 3).collect()
    by_code = {r["node"]: r["root"] for r in found}
    classes = components(codes, 3)
    for i, c in enumerate(signed):
        for j in range(i):
            assert (by_code.get(c, c) == by_code.get(signed[j], signed[j])) == (classes[i] == classes[j])


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 300)] + [(3, 3), (None, 4)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in range(200, 300)}, 7: 7}


@settings(max_examples=80, deadline=None)
@given(st.text("abcd", max_size=30), st.text("abcd", max_size=30))
def test_edits_is_levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    assert chaining.edits(a, b) == row[-1]


def test_chain_takes_the_collinear_matches():
    parts = [(0, 100, 10), (12, 113, 20), (15, 5, 6), (40, 140, 30)]
    assert chaining.chains(parts, 5)[0] == [(0, 100, 10), (12, 113, 20), (40, 140, 30)]
    far = [(0, 0, 10), (500, 500, 10)]
    assert len(chaining.chains(far, 5)) == 2


def test_passages_miss_no_exact_repeat(documents, texts):
    found = substrings.repeated_passages(documents).collect()
    assert repeated_exactly(texts, 50) <= {r["doc_id"] for r in found}
    for r in found:
        a = texts[r["doc_id"]].encode().split()[r["start"] : r["end"]]
        b = texts[r["match_doc_id"]].encode().split()[r["match_start"] : r["match_end"]]
        assert r["match_doc_id"] < r["doc_id"] and r["passage_end"] - r["passage_start"] >= 50
        if r["similarity"] == 1:
            assert a == b
        else:
            assert len({*a} & {*b}) >= 0.7 * len({*a})


def test_fuzzy_passage_and_clean_documents(spark):
    rng = random.Random(1)
    def noise(n):
        return [f"n{rng.randrange(10**9)}" for _ in range(n)]

    passage = noise(60)
    changed = [*passage[:20], "other", *passage[21:40], *passage[41:]]
    rows = [(10, noise(40) + passage + noise(40)), (11, noise(7) + changed + noise(90)), (12, noise(200))]
    rows += [(13, noise(9) + passage[:30] + noise(30)), (14, passage)]
    table = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    found = {(r["doc_id"], r["match_doc_id"], r["start"], r["end"]) for r in substrings.repeated_passages(table).collect()}
    assert found == {(11, 10, 7, 66), (14, 10, 0, 60)}
    left = {r["doc_id"]: r["text"] for r in substrings.drop_passages(table).collect()}
    assert left.keys() == {10, 11, 12, 13}
    assert left[11].split() == rows[1][1][:7] + rows[1][1][66:]
    assert left[10] == " ".join(rows[0][1]) and left[13] == " ".join(rows[3][1])


def test_passage_whose_short_seeds_all_occur_earlier(spark):
    rng = random.Random(5)

    def noise(n):
        return [f"n{rng.randrange(10**9)}" for _ in range(n)]

    passage = noise(60)
    # Every five words of the passage are a phrase of earlier documents of its own.
    rows = [(i, noise(20) + passage[i // 12 : i // 12 + 5] + noise(20)) for i in range(12 * 56)]
    rows += [(1000, noise(30) + passage + noise(30)), (1001, noise(9) + passage + noise(50)), (1002, passage[:20] + noise(80))]
    table = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    found = {(r["doc_id"], r["match_doc_id"], r["start"], r["end"]) for r in substrings.repeated_passages(table).collect()}
    assert found == {(1001, 1000, 9, 69)}


def test_two_passages_around_a_replaced_part(spark):
    rng = random.Random(8)

    def noise(n):
        return [f"n{rng.randrange(10**9)}" for _ in range(n)]

    rows, wanted = [], set()
    # Words of the first passage, of the replaced part on both sides, and of the second passage.
    for i, (p, x, y, q) in enumerate([(60, 40, 40, 60), (100, 60, 60, 100), (50, 30, 30, 50), (50, 200, 90, 70)]):
        first, second = noise(p), noise(q)
        rows += [(2 * i, first + noise(x) + second), (2 * i + 1, noise(20) + first + noise(y) + second + noise(20))]
        wanted |= {(2 * i + 1, 2 * i, 20, 20 + p), (2 * i + 1, 2 * i, 20 + p + y, 20 + p + y + q)}
    kept = noise(200)
    rows += [(100, kept), (101, kept[:90] + noise(20) + kept[110:])]
    table = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    found = substrings.repeated_passages(table).collect()
    assert {(r["doc_id"], r["match_doc_id"], r["start"], r["end"]) for r in found} == wanted | {(101, 100, 0, 200)}
    assert all(r["similarity"] == (0.9 if r["doc_id"] == 101 else 1) for r in found)


def test_edits_near_the_ends_of_a_passage(spark):
    rng = random.Random(11)

    def noise(n):
        return [f"n{rng.randrange(10**9)}" for _ in range(n)]

    rows = []
    for i in range(20):
        passage = noise(60)
        copy = [*passage[:5], "other", *passage[6:54], "words", *passage[55:]]
        rows += [(2 * i, noise(30) + passage + noise(30)), (2 * i + 1, noise(40) + copy + noise(20))]
    table = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    found = {(r["doc_id"], r["match_doc_id"], r["start"], r["end"]) for r in substrings.repeated_passages(table).collect()}
    assert found == {(2 * i + 1, 2 * i, 40, 100) for i in range(20)}


def test_recall_of_fuzzy_passages(spark):
    rng = random.Random(12)

    def noise(n):
        return [f"n{rng.randrange(10**9)}" for _ in range(n)]

    rows, planted = [], {}
    for percent in (3, 5, 10, 15):
        for _ in range(100):
            passage = noise(60)
            copy = [w if rng.randrange(100) >= percent else noise(1)[0] for w in passage]
            rows += [noise(30) + passage + noise(30), noise(40) + copy + noise(20)]
            if sum(x == y for x, y in zip(passage, copy)) >= 48:
                planted.setdefault(percent, set()).add(len(rows) - 1)
    table = spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(rows)], "doc_id long, text string")
    found = {r["doc_id"] for r in substrings.repeated_passages(table).collect()}
    recall = {percent: len(ids & found) / len(ids) for percent, ids in planted.items()}
    assert all(recall[p] >= least for p, least in ((3, 0.99), (5, 0.99), (10, 0.95), (15, 0.85))), recall


def test_passage_whose_anchors_all_occur_earlier(spark):
    rng = random.Random(6)

    def noise(n):
        return [f"n{rng.randrange(10**9)}" for _ in range(n)]

    passage, other = noise(60), noise(50)
    # Every 16 words of the passage are in an earlier document, or earlier in the same document.
    rows = [(i, noise(20) + passage[i : i + 16] + noise(20)) for i in range(45)]
    rows += [(1000, noise(30) + passage + noise(30)), (1001, noise(9) + passage + noise(50))]
    pieces = [w for i in range(0, 35) for w in [*other[i : i + 16], *noise(3)]]
    rows += [(2000, pieces + other + noise(5)), (2001, noise(4) + other + noise(8))]
    table = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    found = {(r["doc_id"], r["match_doc_id"], r["start"], r["end"]) for r in substrings.repeated_passages(table).collect()}
    assert found == {(1001, 1000, 9, 69), (2001, 2000, 4, 54)}


@pytest.mark.parametrize("before", [3, 12])
def test_fuzzy_passage_whose_seeds_all_occur_earlier(spark, before):
    """Every seed of both copies is a phrase of earlier documents of its own, so no first place is the copy."""
    rng = random.Random(7)

    def noise(n):
        return [f"n{rng.randrange(10**9)}" for _ in range(n)]

    passage = noise(60)
    copy = [w if i % 9 != 8 else noise(1)[0] for i, w in enumerate(passage)]
    rows = [(i, noise(20) + passage[i // before : i // before + 5] + noise(20)) for i in range(before * 56)]
    rows += [(900, noise(30) + passage[:5] + noise(40) + passage + noise(30)), (901, noise(9) + copy + noise(50))]
    rows += [(902, passage[:14] + noise(80)), (903, noise(50) + passage[20:36] + noise(50))]
    table = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    found = {(r["doc_id"], r["match_doc_id"], r["start"], r["end"]) for r in substrings.repeated_passages(table).collect()}
    assert found == {(901, 900, 9, 69)}


def test_passage_at_the_second_place_of_the_first_document(spark):
    rng = random.Random(13)

    def noise(n):
        return [f"n{rng.randrange(10**9)}" for _ in range(n)]

    passage = noise(60)
    # Twelve times, each in other words, so that each phrase is a kept seed somewhere.
    phrases = [w for i in range(12 * 56) for w in [*passage[i // 12 : i // 12 + 5], *noise(9)]]
    copy = [w if i % 9 != 8 else noise(1)[0] for i, w in enumerate(passage)]
    rows = [(0, phrases + noise(40) + passage + noise(30)), (1, noise(9) + copy + noise(50))]
    table = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    found = {(r["doc_id"], r["match_start"], r["start"], r["end"]) for r in substrings.repeated_passages(table).collect()}
    assert found == {(1, len(phrases) + 40, 9, 69)}


def test_rows_of_a_fuzzy_family_grow_with_its_members(spark):
    """No first place is a copy, and every copy is alike to all earlier ones: few owners name all its words."""
    rng = random.Random(9)

    def noise(n):
        return [f"n{rng.randrange(10**9)}" for _ in range(n)]

    passage, size = noise(60), 40
    rows = [(i, noise(20) + passage[i // 3 : i // 3 + 5] + noise(20)) for i in range(3 * 56)]
    rows += [(900 + i, noise(9 + i) + [w if k % 9 != 8 else noise(1)[0] for k, w in enumerate(passage)] + noise(30)) for i in range(size)]
    table = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    found = substrings.repeated_passages(table).collect()
    assert {(r["doc_id"], r["passage_start"], r["passage_end"]) for r in found} == {(900 + i, 9 + i, 69 + i) for i in range(1, size)}
    assert len(found) < 4 * size


def test_longest_runs_of_one_word_are_found(spark):
    """Of many runs of one word those that reach farthest, beyond the words compared, are the owners."""
    rng = random.Random(10)

    def noise(n):
        return [f"n{rng.randrange(10**9)}" for _ in range(n)]

    rows = [(i, noise(20) + ["aa"] * n + noise(20) + ["bb"] * n + noise(20)) for i, n in enumerate([6, 9, *[31 + k % 5 for k in range(30)], 47, 33, 60, 32])]
    rows += [(100, noise(7) + ["aa"] * 47 + ["bb"] * 45 + noise(9))]
    table = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    found = [r for r in substrings.repeated_passages(table).collect() if r["doc_id"] == 100]
    assert {(r["passage_start"], r["passage_end"]) for r in found} == {(7, 99)} and len(found) < 12


def test_periodic_runs_and_surroundings_of_several_texts():
    rng, how = random.Random(11), substrings.Passages()
    for _ in range(30):
        texts = [[rng.randrange(10**6) for _ in range(rng.randrange(8))] for _ in range(4)]
        for text in texts:
            period = [rng.randrange(3) for _ in range(rng.randrange(1, 20))]
            text += (period * 60)[: rng.randrange(5, 80)] + [rng.randrange(3) for _ in range(30)]
        words, sizes = np.array(sum(texts, []), dtype=np.uint64), np.array([len(t) for t in texts])
        places = [(row, pos, mark) for row, t in enumerate(texts) for pos in range(len(t)) for mark, w in ((0, 5), (1, 16)) if pos + w <= len(t)]
        row, pos, anchor = (np.array(x) for x in zip(*places))
        runs = substrings.periodic_runs(words, sizes, row, pos, anchor == 1, how)
        around = substrings.surroundings(words, sizes, row, pos, anchor == 1, how)
        for (r, p, mark), run, bins in zip(places, runs.tolist(), around.tolist()):
            text, width = texts[r], 16 if mark else 5
            step = next((k for k in range(1, width + 1) if text[p + k : p + k + width] == text[p : p + width]), None)
            want = width if step is None else next((i for i in range(p, len(text)) if i + step >= len(text) or text[i] != text[i + step]), 0) + step - p
            assert run == want
            first = p - (len(bins) - width) // 2
            assert bins == [text[i] % substrings.BINS if 0 <= i < len(text) else substrings.BINS for i in range(first, first + len(bins))]


@pytest.mark.parametrize("few", [0, 10**9])
def test_alike_pairs_are_those_of_all_pairs(monkeypatch, few):
    monkeypatch.setattr(substrings, "FEW_PAIRS", few)
    monkeypatch.setattr(substrings, "TILE", 7)
    monkeypatch.setattr(substrings, "PAIRS_AT_ONCE", 50)
    rng = np.random.default_rng(4)
    bins = rng.integers(0, 30, (60, 16)).astype(np.uint16)
    bins[rng.random((60, 16)) < 0.1] = substrings.BINS
    group = np.sort(rng.integers(0, 4, 60))
    group = np.unique(group, return_inverse=True)[1]
    left, right = (np.flatnonzero(rng.random(60) < share) for share in (0.5, 0.7))
    wanted = set()
    for a in left.tolist():
        for b in right.tolist():
            there = set(bins[b].tolist()) - {substrings.BINS}
            if group[a] == group[b] and sum(w in there for w in bins[a, 3:13].tolist()) >= 5:
                wanted.add((a, b))
    found = [pair for a, b in substrings.alike_pairs(bins, group, left, right, 3, 5) for pair in zip(a.tolist(), b.tolist())]
    assert len(found) == len(wanted) and set(found) == wanted


def test_pairs_found_by_rare_words_are_those_of_all_pairs():
    """A common sentence around the seed, copies with and without edits, and other words."""
    rng, how = np.random.default_rng(5), substrings.Passages()
    size, n = substrings._width(how), 300
    bins = rng.integers(0, substrings.BINS, (n, size)).astype(np.uint16)
    bins[:, 22:34] = np.arange(12)
    bins[150:170] = bins[:20]
    bins[150:170][rng.random((20, size)) < 0.08] = 99
    bins[170:180, 30:] = 7
    bins[rng.random((n, size)) < 0.05] = substrings.BINS
    rank = np.arange(n) // 2
    left, right = np.arange(0, n, dtype=np.int64)[rng.random(n) < 0.8], np.arange(n)
    some, rest = substrings.rare_pairs(bins, left, right, rank, how)
    pairs = [*some, *substrings.alike_pairs(bins, np.zeros(n, dtype=np.int64), rest, right, 5, 20, rank)]
    assert 0 < len(rest) < len(left) / 2

    def close(a, b):
        alike = substrings.alike_around(bins, a, b, how)
        return list(zip(a[alike].tolist(), b[alike].tolist()))

    a, b = (x.ravel() for x in np.meshgrid(left, right, indexing="ij"))
    found = close(*(np.concatenate(x) for x in zip(*pairs)))
    assert sorted(found) == sorted(close(a[rank[b] < rank[a]], b[rank[b] < rank[a]])) and len(found) > 20


def test_every_exact_run_of_fifty_words_has_an_anchor():
    rng = np.random.default_rng(2)
    how = substrings.Passages()
    run = rng.integers(0, 2**32, 50).astype(np.uint64)
    for _ in range(20):
        kept = []
        for n in rng.integers(0, 90, 2):
            words = np.r_[rng.integers(0, 2**32, n).astype(np.uint64), run, rng.integers(0, 2**32, 40).astype(np.uint64)]
            at, keys = substrings.kept_seeds(words, how)
            inside = (at >= n) & (at <= n + 50 - how.anchor) & (keys % 2 == 1)
            kept.append({(int(p) - int(n), int(k)) for p, k in zip(at[inside], keys[inside])})
        assert kept[0] & kept[1]


def test_passages_awkward_rows(awkward, nothing):
    found = substrings.repeated_passages(awkward).collect()
    assert {(r["doc_id"], r["match_doc_id"], r["start"], r["end"]) for r in found} == {(6, 5, 2, 72)}
    left = substrings.drop_passages(awkward)
    assert left.columns == awkward.columns
    assert [r["text"] for r in left.where("doc_id = 6").collect()] == ["before it after it"] * 2
    assert left.count() == len(AWKWARD)
    assert substrings.repeated_passages(nothing).count() == 0 and substrings.drop_passages(nothing).count() == 0


def family(rng, size, length=400, changed=4):
    base = [f"f{i}" for i in range(length)]
    texts = []
    for n in range(size):
        copy = list(base)
        for at in rng.sample(range(length), changed):
            copy[at] = f"c{n}_{at}"
        texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("size", [50, 200])
def test_family_of_near_copies(spark, size):
    """Few rows per member, and no word of an exact repeat of 50 words is left out."""
    rng = random.Random(size)
    texts = family(rng, size)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = substrings.repeated_passages(table).collect()
    assert len(found) < 3.5 * size
    spans = {}
    for r in found:
        spans.setdefault(r["doc_id"], []).append((r["passage_start"], r["passage_end"]))
    seen = set()
    for name, text in enumerate(texts):
        words = text.split()
        runs = [tuple(words[i : i + 50]) for i in range(len(words) - 49)]
        for i, run in enumerate(runs):
            if run in seen:
                assert any(lo <= i and i + 50 <= hi for lo, hi in spans[name])
        seen.update(runs)


def test_least_cover_and_safe_spans():
    rng = random.Random(2)
    for _ in range(200):
        spans = [(a, a + rng.randint(1, 30)) for a in (rng.randint(0, 100) for _ in range(rng.randint(1, 25)))]
        wanted = substrings.merged([s for s in spans if rng.random() < 0.6] or spans[:1])
        chosen = chaining.least_cover(np.array(spans), wanted)
        covered = {i for at in chosen for i in range(*spans[at])}
        assert all(set(range(lo, hi)) <= covered for lo, hi in wanted)
        assert len(set(chosen)) == len(chosen)
    owner, p = np.array([1, 1, 1, 1, 2]), np.array([0, 55, 100, 400, 0])
    spans = chaining.safe_spans(owner, p, p - 7, np.full(5, 50), 80, 0.8)
    assert spans.tolist() == [[1, 7, 0, 150], [1, 7, 400, 450], [2, 7, 0, 50]]


def test_rows_of_one_id_with_several_texts(spark):
    shared = " ".join(f"word{i}" for i in range(70))
    other = " ".join(f"else{i}" for i in range(90))
    rows = [(1, shared, "a"), (2, f"a frame {shared} behind it", "b"), (2, other, "c"), (2, None, "d"), (3, other, "e")]
    kept = substrings.drop_passages(spark.createDataFrame(rows, "doc_id long, text string, sig string")).collect()
    assert sorted((r["sig"], r["text"]) for r in kept) == [("a", shared), ("b", "a frame behind it"), ("c", other), ("d", None)]


def test_ends_extended_together_are_those_extended_one_by_one():
    rng = random.Random(7)
    pairs = []
    for _ in range(600):
        a = "".join(chr(300 + rng.randrange(rng.choice([2, 4, 40]))) for _ in range(rng.randrange(80)))
        b = list(a)
        for _ in range(rng.randrange(8)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.choice([0, 1, 2, 30])] = [chr(300 + rng.randrange(40)) for _ in range(rng.choice([0, 1, 2, 30]))]
        pairs.append((a, "".join(b)))
    assert chaining.extend_all(pairs) == [chaining.extend(a, b) for a, b in pairs]
    # A passage that shifts beyond the diagonals followed together.
    shifts = "".join(chr(300 + i) for i in range(200))
    far = ("".join(shifts[i : i + 20] + "xyz" for i in range(0, 200, 20)), shifts)
    filled = [p for p in [*pairs, far] if all(p)]
    assert None in chaining._extend_rows(filled) and chaining.extend_all([far]) == [chaining.extend(*far)]
    assert chaining.extend_all([]) == []


@pytest.mark.parametrize("rows_at_once", [1, 3, 1000])
def test_first_places_whatever_the_batches(rows_at_once):
    """Seeds of one document, of few and of many places, also where a batch ends within them."""
    rng = random.Random(rows_at_once)
    rows = {(rng.randrange(12), rng.randrange(3), rng.randrange(2), rng.randrange(9)) for _ in range(60)}
    rows |= {(20, 1, 0, i) for i in range(7)} | {(21, 1, 0, i) for i in range(7)} | {(21, 1, 1, 0), (22, 5, 0, 0), (23, 1, 0, 0)}
    rows = sorted([*rows, *list(rows)[:9]])
    names = ["seed", "doc", "sig", "pos"]
    table = pa.table({n: pa.array(c, pa.int32() if n == "pos" else pa.int64()) for n, c in zip(names, zip(*rows))})
    batches = [pa.record_batch(b) for b in table.to_batches(max_chunksize=rows_at_once)]
    got = [tuple(r.values()) for b in substrings._with_first(iter([batches[0].slice(0, 0), *batches])) for r in b.to_pylist()]
    want = []
    for row in rows:
        own = [r for r in rows if r[0] == row[0]]
        if len({r[1:3] for r in own}) > 1:
            want.append((*row, *own[0][1:], min(len(own), 3)))
    assert sorted(got) == sorted(want) and len(want) > 50
