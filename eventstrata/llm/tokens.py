"""Token ids of public byte-level vocabularies."""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from functools import lru_cache

import tiktoken
from tokenizers import Tokenizer

# The pattern that splits text before the merges of the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=4)
def load_encoder(path: str, special: bool = True) -> Callable[[str], list[int]]:
    """Ids of a text by a tokenizer file (byte-level BPE, ``tokenizers`` format).

    The file's vocabulary and special tokens are taken from the file; the merges are done
    by a faster encoder of the same vocabulary. Equality with the ``tokenizers`` library is
    tested. A special token's string in a text becomes its id, as that library does by
    default; without ``special`` it is ordinary text.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    symbol = byte_of_symbol()
    vocabulary = {bytes(symbol[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
    encoding = tiktoken.Encoding(
        os.path.basename(path), pat_str=PATTERN, mergeable_ranks=vocabulary, special_tokens=added
    )
    allowed = "all" if special else set()

    @lru_cache(maxsize=1)
    def plain() -> Tokenizer:
        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = not special
        return tokenizer

    def encode(text: str) -> list[int]:
        try:
            return encoding.encode(text, allowed_special=allowed, disallowed_special=())
        except ValueError:  # the pattern's stack overflows on very long runs of white space
            return plain().encode(text, add_special_tokens=False).ids

    return encode
