from __future__ import annotations

import hashlib
import json
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from brute import AWKWARD_SCHEMA, SF
from tokenizers import Tokenizer

from eventstrata.llm import alignment, pair_hash
from eventstrata.llm.queries import BYTE_BPE, PIECE_MODEL, REGISTRY

NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def symbol_bytes():
    """The byte-level alphabet, by the rule that its inventors published."""
    keep = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    table, extra = {chr(b): b for b in keep}, 0
    for b in range(256):
        if b not in keep:
            table[chr(256 + extra)] = b
            extra += 1
    return table


def plain(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every text, token by token."""
    tok = Tokenizer.from_file(BYTE_BPE)
    tok.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    alphabet = symbol_bytes()
    docs = []
    for text in texts:
        if not text:
            docs.append(None)
            continue
        a = tok.encode(" " + text, add_special_tokens=False).ids
        b = model.encode(text)
        a_bytes = [bytes(alphabet[c] for c in tok.id_to_token(i)) for i in a]
        b_bytes = [
            bytes([int(model.id_to_piece(i)[3:5], 16)])
            if model.is_byte(i)
            else model.id_to_piece(i).replace("▁", " ").encode()
            for i in b
        ]
        whole = (" " + text).encode()
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            docs.append(None)
            continue
        ends = []
        for side in (a_bytes, b_bytes):
            at, places = 0, []
            for t in side:
                at += len(t)
                places.append(at)
            ends.append(places)
        both = sorted(set(ends[0]) & set(ends[1]))
        links = [(a[ends[0].index(e)], b[ends[1].index(e)]) for e in both] if len(a) < 3000 else None
        if links is None:
            where = [dict(zip(e, ids)) for e, ids in zip(ends, (a, b))]
            links = [(where[0][e], where[1][e]) for e in both]
        groups, i, j = [], 0, 0
        for e in both:
            left, right = [], []
            while i < len(a) and ends[0][i] <= e:
                left.append(str(a[i]))
                i += 1
            while j < len(b) and ends[1][j] <= e:
                right.append(str(b[j]))
                j += 1
            groups.append(",".join(left) + "|" + ",".join(right))
        docs.append((len(a), len(b), links, ";".join(groups)))
    count = Counter(link for d in docs if d for link in d[2])
    highest: dict = {}
    for (_, b), n in count.items():
        highest[b] = max(n, highest.get(b, 0))
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, links, groups = d
        best = sum(count[x] == highest[x[1]] for x in links)
        out.append((n_a, n_b, len(links), len(links), best, sum(count[x] for x in links), groups))
    return out


ODD = [
    "plain words and <|endoftext|> and <s> and <0x41> and <unk>",
    "a mark ▁ in the text",
    "emoji \U0001f600\U0001f9d1‍\U0001f680 and กข and 你好",
    "a\x00b \x01\x7f",
    "   many   blanks \n\n\t tabs ",
    " ",
    "\n",
    "x" * 5000,
    "é combining",
]


@pytest.fixture(scope="module")
def odd(spark, awkward):
    return awkward.unionByName(spark.createDataFrame([(100 + i, t, "", 0) for i, t in enumerate(ODD)], AWKWARD_SCHEMA))


def compare(found, rows):
    got = sorted([(r["doc_id"], *[r[c] for c in NUMBERS], r["groups"]) for r in found.collect()], key=str)
    assert got == sorted([(d, *p) for (d, _), p in zip(rows, plain([t for _, t in rows]))], key=str)


def test_query_equals_token_by_token(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    want = {d: p for (d, _), p in zip(rows, plain([t for _, t in rows]))}
    found = REGISTRY["op11_cross_tokenizer"](spark, SF)
    assert found.columns == ["doc_id", *NUMBERS, "groups_sha256"]
    got = found.collect()
    assert len(got) == len(rows)
    for r in got:
        *numbers, groups = want[r["doc_id"]]
        assert [r[c] for c in NUMBERS] == numbers
        assert r["groups_sha256"] == (hashlib.sha256(groups.encode()).hexdigest() if numbers[0] else "")


@pytest.mark.parametrize("max_pairs", [alignment.MAX_PAIRS, 10])
def test_awkward_rows_both_ways(odd, max_pairs):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    compare(alignment.alignments(odd, BYTE_BPE, PIECE_MODEL, max_pairs), rows)


@pytest.mark.parametrize("max_pairs", [alignment.MAX_PAIRS, -1])
def test_nothing_to_align(spark, nothing, max_pairs):
    assert alignment.alignments(nothing, BYTE_BPE, PIECE_MODEL, max_pairs).collect() == []
    empty = spark.createDataFrame([(1, None, "", 0), (2, "", "", 0)], AWKWARD_SCHEMA)
    compare(alignment.alignments(empty, BYTE_BPE, PIECE_MODEL, max_pairs), [(1, None), (2, "")])


def test_hash_is_perfect_and_verifies(spark):
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 50, 100_000))
    table = spark.createDataFrame([(int(k),) for k in keys], "key long")
    hashed = pair_hash.perfect_hash(table, len(keys))
    assert np.array_equal(np.sort(hashed.slots(keys)), np.arange(len(keys)))
    assert np.array_equal(hashed.keys[hashed.slots(keys[::-1])], keys[::-1])
    assert len(hashed.words) * 64 < 4 * len(keys)  # bits per key, without the keys kept to verify
    with pytest.raises(KeyError):
        hashed.slots(np.array([keys[0], (1 << 60) + 1]))


def test_hash_of_no_keys(spark):
    hashed = pair_hash.perfect_hash(spark.createDataFrame([], "key long"), 0)
    assert len(hashed) == 0 and len(hashed.slots(np.zeros(0, dtype=np.int64))) == 0


def test_byte_table_is_the_files():
    with open(BYTE_BPE, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    alphabet = symbol_bytes()
    table = alignment.byte_level_tokens(BYTE_BPE)
    special = {"<|endoftext|>"}
    assert all(table[i] == bytes(alphabet[c] for c in t) for t, i in vocabulary.items() if t not in special)


def test_portions_hold_all_rows_and_few_tokens():
    rng = np.random.default_rng(4)
    sizes = [0, 5, alignment.TOKENS, 3, 0, 2 * alignment.TOKENS, 1, *rng.integers(0, alignment.TOKENS // 3, 20), 0]
    lists = pa.array([np.ones(n, dtype="<u2").tobytes() for n in sizes], pa.binary())
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sizes))), lists, lists], names=["row", "a", "b"])
    parts = list(alignment._portions(iter([batch, batch.slice(0, 0)])))
    assert [r for p in parts for r in p.column("row").to_pylist()] == list(range(len(sizes)))
    assert all(p.num_rows == 1 or sum(len(x) for x in p.column("a").to_pylist()[:-1]) <= alignment.TOKENS for p in parts)
    lengths = np.ones(2, dtype=np.int64), np.ones(2, dtype=np.int64)
    whole = alignment.Aligned(batch, lengths)
    assert sum(len(alignment.Aligned(p, lengths).links()) for p in parts) == len(whole.links()) == sum(sizes)
