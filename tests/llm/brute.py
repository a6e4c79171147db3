"""Plain versions of the operators, and rows that every operator must take."""

from __future__ import annotations

import re

import xxhash

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SHARED = " ".join(f"word{i}" for i in range(70))
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
# Columns: doc_id, text, plus names that operators use inside.
AWKWARD = [
    (1, "token = \"abcdef1234567890abcdef12\" and some plain words here", "a", 1),
    (2, None, None, None),
    (3, "", "b", 2),
    (4, "  \n\t ", "c", 3),
    (5, SHARED, "d", 4),
    (6, "before it " + SHARED + " after it", "e", 5),
    (6, "before it " + SHARED + " after it", "e", 5),
    (7, LONG, "f", 6),
    (None, "a row without an id but with " + SHARED, "g", 7),
    (8, "Licensed under CC BY-NC 4.0.\nother", "h", 8),
]
AWKWARD_SCHEMA = "doc_id long, text string, code string, seed long"


def components(codes, radius):
    parent = list(range(len(codes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(codes):
        for j in range(i):
            if (a ^ codes[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(codes))]


def simhash(text, width):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    width = min(width, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + width]).encode(), 42) for i in range(len(words) - width + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def base_counts(text):
    words = WORD.findall(text or "")
    seen = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    repeat = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeat)


ASSIGN = re.compile(
    r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
    r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found))


def repeated_exactly(texts, least):
    """Ids of documents with a run of ``least`` words that a document of smaller id has."""
    owners = {}
    for name, text in texts.items():
        words = WORD.findall(text or "")
        for i in range(len(words) - least + 1):
            owners.setdefault(tuple(words[i : i + least]), set()).add(name)
    return {d for docs in owners.values() if len(docs) > 1 for d in docs - {min(docs)}}
