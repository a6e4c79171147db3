"""Statistics of one text, computed on its bytes with numpy."""

from __future__ import annotations

from zlib import crc32

import numpy as np

SYMBOLS = b"#*$%&|<>"
# Multiplier that mixes word hashes into window hashes.
MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, words), dtype=np.uint64, count=len(words))


def window_hashes(words: np.ndarray, width: int, at: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` words, or of those ``at``; empty if there are fewer words."""
    n = len(words) - width + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint64)
    mixed = np.zeros(n if at is None else len(at), dtype=np.uint64)
    for i in range(width):
        mixed = (mixed ^ (words[i : i + n] if at is None else words[at + i])) * MIX
        mixed ^= mixed >> np.uint64(29)
    return mixed


def repeated_words(hashes: np.ndarray, width: int) -> int:
    """Words inside windows of ``width`` words that occur twice or more in the text."""
    windows = window_hashes(hashes, width)
    if len(windows) < 2:
        return 0
    order = np.argsort(windows, kind="stable")
    sorted_ = windows[order]
    same = sorted_[1:] == sorted_[:-1]
    if not same.any():
        return 0
    again = np.r_[False, same] | np.r_[same, False]
    cover = np.zeros(len(hashes) + 1, dtype=np.int64)
    at = order[again]
    cover[at] += 1
    cover[at + width] -= 1
    return int((np.cumsum(cover[:-1]) > 0).sum())


def repeated_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.split(None, 1)]
    return len(lines), len(lines) - len(set(lines))


def byte_counts(text: bytes) -> np.ndarray:
    return np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
