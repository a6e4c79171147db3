"""SentencePiece by weighted transducers: normaliser, pieces, byte fallback, shortest path."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from math import inf
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as model_format

from eventstrata.llm.common import text_bytes
from eventstrata.llm.transducers import Lattice, normaliser, rewriting, speller

SPACE = "▁"
UNIGRAM, BPE, NORMAL, UNKNOWN, BYTE = 1, 2, 1, 2, 6
# Weight of a fallback character: in BPE models the only weight there is, in unigram models
# what their library adds to the weight of the unlikeliest piece.
BPE_FALLBACK, UNIGRAM_FALLBACK = 1.0, 10.0
# Parts whose shortest path a worker remembers; longer parts than LONGEST are not kept.
REMEMBERED, LONGEST = 400_000, 48
# Texts are cut into parts together until they have so many characters.
CHARACTERS = 1 << 20


class PieceTransducer:
    """Text to piece ids for a BPE or unigram model with byte fallback.

    Three machines are compiled: the normaliser writes a space mark in front and for every
    space; the speller spells pieces, in a unigram model at the weight of minus their score;
    fallback adds an arc per character outside the vocabulary. For BPE a fourth machine runs
    over the pieces: its state is the last piece, and the arc to the next weighs 0 if
    merging the two pieces' characters by the model's scores gives back exactly these two,
    else it is infinite. A sequence of merges is the model's own exactly if all its
    neighbours are stable in this sense, so the tropical shortest path through the
    composition with an input is the model's segmentation; fallback characters become the
    pieces of their bytes. Input is composed in parts, cut where no piece can lie across; the
    parts of many texts are cut and told apart on arrays, and each is composed once.
    """

    def __init__(self, path: str):
        proto = model_format.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        spec, kind = proto.normalizer_spec, proto.trainer_spec.model_type
        if kind not in (BPE, UNIGRAM) or not proto.trainer_spec.byte_fallback:
            raise ValueError("only BPE and unigram models with byte fallback are supported")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
            raise ValueError("only the identity normaliser with a dummy prefix is supported")
        self.pieces = [p.piece for p in proto.pieces]
        self.score = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.byte = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.kind = [p.type for p in proto.pieces]
        self.raw = [self.bytes_of(i) for i in range(len(self.pieces))]
        unigram = kind == UNIGRAM
        weights = {
            p.piece: (i, -p.score if unigram else 0.0) for i, p in enumerate(proto.pieces) if p.type == NORMAL
        }
        self.front, self.rewrite = rewriting(normaliser(SPACE))
        fallback = UNIGRAM_FALLBACK - min(self.score.values(), default=0.0) if unigram else BPE_FALLBACK
        self.lattice = Lattice(speller(weights), fallback, None if unigram else self.between)
        # Vocabulary characters by number, 0 for all others, and which two stand next to each other in a piece.
        alphabet = sorted({c for p in self.score for c in p})
        self.letter = np.zeros(0x110000, dtype=np.uint16 if len(alphabet) < 1 << 16 else np.uint32)
        self.letter[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        self.joined = np.zeros((len(alphabet) + 1, len(alphabet) + 1), dtype=bool)
        for p in self.score:
            row = self.letter[[ord(c) for c in p]]
            self.joined[row[:-1], row[1:]] = True
        self.stable: dict[int, float] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def bytes_of(self, piece: int) -> bytes:
        """What a piece decodes to; control pieces to nothing."""
        if self.kind[piece] == BYTE:
            return bytes([int(self.pieces[piece][3:5], 16)])
        return {NORMAL: self.pieces[piece], UNKNOWN: " ⁇ "}.get(self.kind[piece], "").encode("utf-8")

    def merged(self, text: str) -> list[str]:
        """Merge characters by score, best first and leftmost at ties."""
        parts, score = list(text), self.score.get
        scores = [score(x + y, -inf) for x, y in zip(parts, parts[1:])]
        while scores:
            best = max(scores)
            if best == -inf:
                break
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = score(parts[at - 1] + parts[at], -inf)
            if at < len(scores):
                scores[at] = score(parts[at] + parts[at + 1], -inf)
        return parts

    def between(self, last: int, piece: int) -> float:
        """Weight of the arc from state ``last`` to ``piece``."""
        pair = last << 32 | piece
        found = self.stable.get(pair)
        if found is None:
            if len(self.stable) > REMEMBERED:
                self.stable.clear()
            a, b = self.pieces[last], self.pieces[piece]
            found = self.stable[pair] = 0.0 if self.merged(a + b) == [a, b] else inf
        return found

    def starts(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where parts begin in the code points of texts that begin at ``first``.

        A part ends where two characters meet that no piece has next to each other: every
        path passes such a place, and no merge crosses it, so the parts' paths make up the
        text's. Words end there, and long runs without spaces, as in scripts that write
        none, fall into short parts that come again.
        """
        letter = self.letter[codes]
        begins = np.ones(len(codes), dtype=bool)
        begins[1:] = ~self.joined[letter[:-1], letter[1:]]
        begins[first] = True
        return np.flatnonzero(begins)

    def cut(self, text: str) -> list[str]:
        """The parts of a text as it is, without the normaliser."""
        at = self.starts(np.frombuffer(text.encode("utf-32-le"), dtype="<u4"), np.zeros(min(len(text), 1), dtype=int))
        return [text[s:e] for s, e in zip(at.tolist(), [*at[1:].tolist(), len(text)])]

    def path(self, part: str) -> list[int]:
        """Ids along the shortest path of one part, fallback characters as their bytes' pieces."""
        out: list[int] = []
        for label in self.lattice.shortest(part):
            if label >= 0:
                out.append(label)
            else:
                out += [self.byte[b] for b in chr(~label).encode("utf-8")]
        return out

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. Parts are encoded once, however often they are in the texts."""
        filled = []
        for text in texts:
            for read, written in self.rewrite if text else ():
                text = text.replace(read, written)
            filled.append(self.front + text if text else "")
        whole = "".join(filled)
        sizes = np.array([len(text) for text in filled], dtype=np.int64)
        ends = np.cumsum(sizes)
        if not whole:
            return [np.zeros(0, dtype=np.int32) for _ in texts]
        codes = np.frombuffer(whole.encode("utf-32-le"), dtype="<u4")
        at = self.starts(codes, (ends - sizes)[sizes > 0])
        # The parts as a column over the texts' UTF-8 bytes.
        width = 1 + (codes > 0x7F) + (codes > 0x7FF).astype(np.int8) + (codes > 0xFFFF)
        before = np.r_[0, np.cumsum(width, dtype=np.int64)]
        offsets = pa.py_buffer(before[np.r_[at, len(codes)]])
        parts = pa.Array.from_buffers(pa.large_string(), len(at), [None, offsets, pa.py_buffer(whole.encode("utf-8"))])
        parts = parts.dictionary_encode()
        found = [self.known.get(part) or self.recall(part) for part in parts.dictionary.to_pylist()]
        count = np.array([len(ids) for ids in found], dtype=np.int64)
        ids = np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(count.sum()))
        number = parts.indices.to_numpy()
        count, first = count[number], (np.cumsum(count) - count)[number]
        last = np.cumsum(count)
        out = ids[np.arange(last[-1]) + np.repeat(first - last + count, count)]
        edges = np.r_[0, last][np.searchsorted(at, np.r_[0, ends])].tolist()
        return [out[lo:hi] for lo, hi in zip(edges, edges[1:])]

    def recall(self, part: str) -> tuple[int, ...]:
        """The path of a part that is not in the young memo: from the old one or anew, put into the young one.

        A full memo becomes the old one and what is still used moves over from it, so
        frequent parts stay known and memory is bounded by two memos.
        """
        found = self.old.get(part) or tuple(self.path(part))
        if len(part) <= LONGEST:
            if len(self.known) >= REMEMBERED:
                self.old, self.known = self.known, {}
            self.known[part] = found
        return found

    def decode(self, ids: list[int]) -> str:
        """The text of ids: bytes are joined, broken ones replaced, the first space dropped."""
        raw = b"".join(map(self.raw.__getitem__, ids))
        text = raw.decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def transducer(path: str) -> PieceTransducer:
    return PieceTransducer(path)


def _encoded(machine: PieceTransducer, column: pa.Array) -> Iterator[tuple[int, list[str | None], list[np.ndarray]]]:
    """(first row, texts, ids per text) of some rows at a time; a null has no ids."""
    texts, held, start = [], 0, 0
    for at, raw in enumerate(text_bytes(column), 1):
        texts.append(None if raw is None else raw.decode("utf-8", "replace"))
        held += len(raw or b"")
        if held >= CHARACTERS or at == len(column):
            yield start, texts, machine.encode_all([text or "" for text in texts])
            texts, held, start = [], 0, at


def encode_documents(documents: DataFrame, model: str) -> DataFrame:
    """One row per document: doc_id, ids (array), decoded (the text of the ids).

    Null texts have null ids and a null text, empty ones no ids and an empty text; U+2581 in
    a text decodes to a space, as the model's marks do. Repeated rows and null ids stay as
    they are, other columns are not read, an empty table gives an empty result. Texts are
    encoded whole; memory is one portion of texts, at least one, and a bounded memo of parts.
    """

    def run(batches):
        machine = transducer(model)
        for batch in batches:
            for start, texts, found in _encoded(machine, batch.column("text")):
                some = [None if text is None else ids for text, ids in zip(texts, found)]
                decoded = [None if ids is None else machine.decode(ids.tolist()) for ids in some]
                arrays = [
                    batch.column("doc_id").slice(start, len(texts)),
                    pa.array(some, pa.list_(pa.int32())),
                    pa.array(decoded, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "ids", "decoded"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def encoded_digest(documents: DataFrame, model: str) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 (unsigned 32-bit ids), round_trip (decoding gives the text).

    As encode_documents, but ids and texts stay in the task. A null text counts as empty.
    """

    def run(batches):
        machine = transducer(model)
        for batch in batches:
            size, check, same = [], [], []
            for _, texts, found in _encoded(machine, batch.column("text")):
                for text, ids in zip(texts, found):
                    size.append(len(ids))
                    check.append(crc32(ids.astype("<u4").tobytes()))
                    same.append(machine.decode(ids.tolist()) == (text or "").replace(SPACE, " "))
            arrays = [batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(check, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(same, pa.bool_())], names=["doc_id", "n_pieces", "ids_crc32", "round_trip"]
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_pieces long, ids_crc32 long, round_trip boolean"
    return documents.select("doc_id", "text").mapInArrow(run, schema)
