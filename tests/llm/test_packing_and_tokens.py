from __future__ import annotations

from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventstrata.llm import packing, token_files
from eventstrata.llm.tokens import load_encoder
from eventstrata.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_encoder_equals_library(library, texts):
    encode = load_encoder(PATH)
    odd = ["", " a<|endoftext|>b <|endoftext|>  x", "x\n\n y\t　z  ", "I'll don't 123 ４ \U0001f469‍\U0001f467 \x00"]
    for text in [*odd, *[t or "" for t in texts.values()]]:
        assert encode(text) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [" " * 1_000_000, "word " * 9 + "\n " * 300_000 + "<|endoftext|> end", "a" * 300_000])
def test_encoder_takes_very_long_runs(library, text):
    assert load_encoder(PATH)(text) == library.encode(text, add_special_tokens=False).ids
    library.encode_special_tokens = True
    try:
        assert load_encoder(PATH, special=False)(text) == library.encode(text, add_special_tokens=False).ids
    finally:
        library.encode_special_tokens = False


def check_pack(lengths, window):
    pieces = packing.pack(lengths, window)
    covered = sorted((d, s, n) for sequence in pieces for d, s, n in sequence)
    at = [0] * len(lengths)
    for d, s, n in covered:
        assert s == at[d] and n > 0
        at[d] += n
    assert at == lengths
    totals = [sum(n for _, _, n in sequence) for sequence in pieces]
    assert all(t == window or t & (t - 1) == 0 and t < window for t in totals)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=60), st.sampled_from([8, 64, 100]))
def test_pack_covers_everything_without_padding(lengths, window):
    check_pack(lengths, window)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=60))
def test_best_fit_is_tightest(lengths):
    windows = packing.best_fit_decreasing(lengths, 50)
    expected = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        open_ = [w for w in expected if sum(lengths[j] for j in w) + lengths[i] <= 50]
        if open_:
            max(open_, key=lambda w: sum(lengths[j] for j in w)).append(i)
        else:
            expected.append([i])
    assert sorted(sum(lengths[i] for i in w) for w in windows) == sorted(sum(lengths[i] for i in w) for w in expected)


def check_pieces(rows, wanted):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert by_doc.keys() == wanted.keys()
    for name, ids in wanted.items():
        at = 0
        for r in sorted(by_doc[name], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.WINDOW


def test_pack_documents(documents, texts, library):
    def ids(text):
        return np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")

    pieces = packing.pack_documents(documents, PATH)
    check_pieces(pieces.collect(), {d: ids(t) for d, t in texts.items()})
    assert packing.padding(pieces).first()["padding"] == 0


def test_pack_awkward_rows(awkward, nothing, library):
    rows = packing.pack_documents(awkward.where("doc_id is null or doc_id <> 6"), PATH).collect()
    wanted = {r["doc_id"]: r["text"] or "" for r in awkward.collect() if r["doc_id"] != 6}
    check_pieces(
        rows,
        {d: np.array([*library.encode(t, add_special_tokens=False).ids, 1], dtype="<u4") for d, t in wanted.items()},
    )
    twice = packing.pack_documents(awkward.where("doc_id = 6"), PATH)
    assert twice.agg(F.sum("length"), F.max("doc_tokens") * 2).first()[:] == twice.agg(F.sum("length"), F.sum("length")).first()[:]
    assert packing.pack_documents(nothing, PATH).count() == 0


@pytest.mark.parametrize("id_bytes, block", [(2, 64), (2, 1 << 20), (4, 4096)])
def test_token_files(spark, awkward, id_bytes, block):
    encode = load_encoder(PATH, special=False)
    rows = awkward.coalesce(1)
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(rows, path, PATH, 50256, id_bytes)
    counted = token_files.count_tokens(token_files.token_blocks(spark, path, id_bytes, block), 50256, id_bytes)
    found = counted.orderBy("file", "ordinal").collect()
    wanted = [len(encode(r["text"] or "")) for r in rows.collect()]
    assert [r["n_tokens"] for r in found] == wanted
    assert [r["start"] for r in found] == np.r_[0, np.cumsum(np.array(wanted) + 1)[:-1]].tolist()
    assert all(r["terminated"] for r in found)


def test_open_ends_and_empty_blocks(spark):
    ids = np.array([5, 50256, 7, 8], dtype="<u2").tobytes()
    blocks = [("f", 0, ids[:4]), ("f", 1, ids[4:]), ("g", 0, ids[4:]), ("g", 1, ids[2:4]), ("h", 0, b"")]
    table = spark.createDataFrame([(f, b, bytearray(x)) for f, b, x in blocks], "file string, block int, bytes binary")
    got = [tuple(r) for r in token_files.count_tokens(table, 50256).orderBy("file", "ordinal").collect()]
    assert got == [("f", 0, 0, 1, True), ("f", 1, 2, 2, False), ("g", 0, 0, 2, True)]
    assert token_files.count_tokens(table.limit(0), 50256).count() == 0


def test_no_rows_and_bad_separator(spark, nothing):
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(nothing, path, PATH, 50256)
    assert token_files.count_tokens(token_files.token_blocks(spark, path), 50256).count() == 0
    with pytest.raises(ValueError):
        token_files.write_token_files(nothing, path, PATH, 0xD800)
    with pytest.raises(ValueError):
        token_files.write_token_files(nothing, path, PATH, 70_000)
