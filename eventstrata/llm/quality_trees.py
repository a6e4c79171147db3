"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventstrata.llm.common import held_out, least_hashed, text_bytes
from eventstrata.llm.textstats import SYMBOLS, byte_counts, repeated_lines, repeated_words, word_hashes
from eventstrata.session import scratch_path, stage

# Labelled rows that the trees are fitted on, at most; their statistics travel to the driver.
MAX_TRAINING_ROWS = 20_000
THRESHOLD = 0.7

STATISTICS = (
    "log_chars",
    "log_words",
    "word_length",
    "word_length_spread",
    "longest_word",
    "upper_share",
    "digit_share",
    "symbol_per_word",
    "pipe_per_word",
    "exclamation_per_word",
    "punctuation_share",
    "non_ascii_share",
    "newline_share",
    "space_share",
    "line_words",
    "repeated_line_share",
    "distinct_word_share",
    "top_word_share",
    "same_as_last_word_share",
    "repeated_5_share",
    "repeated_8_share",
    "byte_entropy",
    "capital_start_share",
    "sentence_ends_per_word",
)


def statistics(text: bytes | None) -> list[float]:
    """The values of STATISTICS for one text; all zero without a word."""
    words = (text or b"").split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(text)
    counts = byte_counts(text)
    hashes = word_hashes(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    lines, again = repeated_lines(text)
    _, frequency = np.unique(hashes, return_counts=True)
    share = counts[counts > 0] / size
    upper = counts[65:91].sum()
    letters = upper + counts[97:123].sum()
    punctuation = sum(int(counts[b]) for b in b".,;:!?'\"()-")
    return [
        np.log1p(size),
        np.log1p(n),
        lengths.mean(),
        lengths.std(),
        float(lengths.max()),
        upper / max(letters, 1),
        counts[48:58].sum() / size,
        sum(int(counts[b]) for b in SYMBOLS) / n,
        counts[124] / n,
        counts[33] / n,
        punctuation / size,
        counts[128:].sum() / size,
        counts[10] / size,
        counts[32] / size,
        n / max(lines, 1),
        again / max(lines, 1),
        len(frequency) / n,
        frequency.max() / n,
        float((hashes[1:] == hashes[:-1]).sum()) / n,
        repeated_words(hashes, 5) / n,
        repeated_words(hashes, 8) / n,
        float(-(share * np.log2(share)).sum()),
        sum(w[:1].isupper() for w in words) / n,
        int(counts[46]) / n,
    ]


def document_statistics(text: Column) -> Column:
    @F.arrow_udf("array<float>")
    def compute(texts: pa.Array) -> pa.Array:
        rows = [statistics(t) for t in text_bytes(texts)]
        return pa.array(rows, pa.list_(pa.float32()))

    return compute(text)


@dataclass(frozen=True)
class Forest:
    """All trees in flat arrays: node i sends x[feature] <= threshold to left, else to right.

    A leaf points to itself, so every row takes the same number of steps and the traversal
    is plain array indexing over rows and trees.
    """

    start: float
    root: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.root, (len(x), len(self.root)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            low = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(low, self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.start + self.value[at].sum(axis=1))))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 80,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 64,
    penalty: float = 1.0,
    least_weight: float = 2.0,
) -> Forest:
    """Boost trees on binned columns with second-order gains; without rows, a constant 0.5."""
    x, y = np.asarray(x, dtype=np.float32), np.asarray(y, dtype=float)
    share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots: list[int] = []

    def leaf(value: float) -> int:
        at = len(nodes["value"])
        for key, v in zip(nodes, (0, np.inf, at, at, value)):
            nodes[key].append(v)
        return at

    if len(y):
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])).astype(np.float32) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
        offset = np.arange(x.shape[1]) * bins
        margin = np.full(len(y), start)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = p - y, p * (1 - p)
            open_ = [(leaf(0.0), np.arange(len(y)), 0)]
            roots.append(open_[0][0])
            while open_:
                at, rows, level = open_.pop()
                g, h = grad[rows].sum(), hess[rows].sum()
                best = (1e-6, None, None)
                if level < depth and h > 2 * least_weight:
                    cell = (binned[rows] + offset).ravel()
                    size = x.shape[1] * bins
                    gs = np.bincount(cell, np.repeat(grad[rows], x.shape[1]), size).reshape(-1, bins).cumsum(axis=1)
                    hs = np.bincount(cell, np.repeat(hess[rows], x.shape[1]), size).reshape(-1, bins).cumsum(axis=1)
                    gain = gs**2 / (hs + penalty) + (g - gs) ** 2 / (h - hs + penalty) - g**2 / (h + penalty)
                    gain[(hs < least_weight) | (h - hs < least_weight)] = 0
                    f, b = np.unravel_index(gain.argmax(), gain.shape)
                    if gain[f, b] > best[0] and b < len(cuts[f]):
                        best = (gain[f, b], int(f), int(b))
                if best[1] is None:
                    nodes["value"][at] = -rate * g / (h + penalty)
                    margin[rows] += nodes["value"][at]
                    continue
                _, f, b = best
                low = binned[rows, f] <= b
                nodes["feature"][at], nodes["threshold"][at] = f, cuts[f][b]
                for side, part in (("left", rows[low]), ("right", rows[~low])):
                    nodes[side][at] = leaf(0.0)
                    open_.append((nodes[side][at], part, level + 1))
    return Forest(
        start=start,
        root=np.array(roots, dtype=np.int32),
        feature=np.array(nodes["feature"], dtype=np.int32),
        threshold=np.array(nodes["threshold"], dtype=np.float32),
        left=np.array(nodes["left"], dtype=np.int32),
        right=np.array(nodes["right"], dtype=np.int32),
        value=np.array(nodes["value"], dtype=float),
        depth=depth,
    )


def predict(values: Column, forest: Forest, block: int = 4096) -> Column:
    """Probability of label 1 from a column of document statistics."""

    @F.arrow_udf("double")
    def score(rows: pa.Array) -> pa.Array:
        flat = rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))
        parts = [forest.score(flat[i : i + block]) for i in range(0, len(flat), block)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return score(values)


def train(described: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> Forest:
    """Fit on labelled rows of ``described`` (doc_id, stats) outside the held-out fold.

    At most ``max_rows`` of them, chosen by a hash of their id; only those reach the driver.
    A document with several labels counts as bad if any says so. Null labels teach nothing.
    """
    usable = labels.where(F.col("quality").isNotNull() & ~held_out())
    target = usable.groupBy("doc_id").agg(F.min("quality").alias("_label"))
    # The bound on the hash of the id reaches both sides below their join.
    joined = described.join(target, "doc_id").select("stats", "_label", F.xxhash64("doc_id").alias("_by"))
    sample = least_hashed(joined, "_by", ["stats"], max_rows, usable.count(), "stats", "_label")
    x = np.array([r["stats"] for r in sample], dtype=np.float32).reshape(-1, len(STATISTICS))
    return fit(x, np.array([r["_label"] for r in sample], dtype=int) > 0)


def score_documents(
    documents: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Only the text is looked at; other columns are not read. Null and empty texts have
    all-zero statistics and are scored like any other row, a null doc_id is never held out
    (false) and never labelled, repeated rows stay repeated. Without any label the score
    is 0.5.
    """
    described = documents.select("doc_id", document_statistics(F.col("text")).alias("stats"))
    described = stage(described, scratch_path(documents.sparkSession, "statistics"))
    forest = train(described, labels, max_rows)
    scored = described.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        predict(F.col("stats"), forest).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """The rows whose score reaches the threshold, all columns as they are.

    Statistics are computed twice, once to learn and once to decide; the decision is then
    row by row and needs no join, so texts are not shuffled and repeated or null ids are
    safe. Without any label every row stays: there is nothing to reject by.
    """
    described = documents.select("doc_id", document_statistics(F.col("text")).alias("stats"))
    described = stage(described, scratch_path(documents.sparkSession, "statistics"))
    forest = train(described, labels, max_rows)
    if not len(forest.root):
        return documents
    return documents.where(predict(document_statistics(F.col("text")), forest) >= THRESHOLD)
