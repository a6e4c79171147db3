"""Quality rules by weak supervision: rules vote or abstain, EM weighs them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventstrata.llm.common import text_bytes
from eventstrata.llm.textstats import SYMBOLS, byte_counts, repeated_lines, repeated_words, word_hashes
from eventstrata.session import scratch_path, stage

WINDOW = 8
MOST_ERRORS = 0.005
COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_letters",
    "n_exclamations",
    "n_top_word",
)


def counts_of(text: bytes | None) -> list[int]:
    """The values of COUNTS for one text; words end at the six ASCII white-space bytes."""
    if not text:
        return [0] * len(COUNTS)
    words = text.split()
    seen = byte_counts(text)
    hashes = word_hashes(words)
    lines, again = repeated_lines(text)
    continuation = int(seen[128:192].sum())
    blank = int(seen[32] + seen[9:14].sum())
    upper = int(seen[65:91].sum())
    top = int(np.unique(hashes, return_counts=True)[1].max()) if words else 0
    return [
        len(words),
        len(text) - continuation - blank,
        sum(int(seen[b]) for b in SYMBOLS),
        again,
        repeated_words(hashes, WINDOW),
        lines,
        upper,
        upper + int(seen[97:123].sum()),
        int(seen[33]),
        top,
    ]


def text_counts(text: Column) -> Column:
    schema = pa.struct([(name, pa.int64()) for name in COUNTS])

    @F.arrow_udf("struct<" + ",".join(f"{c}:long" for c in COUNTS) + ">")
    def compute(texts: pa.Array) -> pa.Array:
        rows = [dict(zip(COUNTS, counts_of(t))) for t in text_bytes(texts)]
        return pa.array(rows, schema)

    return compute(text)


@dataclass(frozen=True)
class Rule:
    """Votes on ``value``: good up to ``good``, bad from ``bad`` on, else it abstains.

    With ``good`` above ``bad`` the direction is reversed. A null value abstains.
    """

    name: str
    value: str
    good: float
    bad: float

    def vote(self) -> Column:
        value = F.expr(self.value)
        if self.good <= self.bad:
            good, bad = value <= self.good, value >= self.bad
        else:
            good, bad = value >= self.good, value <= self.bad
        return F.when(bad, -1).when(good, 1).otherwise(0)


RULES = (
    Rule("length", "n_words", 50, 12),
    Rule("long_words", "try_divide(word_chars, n_words)", 10, 14),
    Rule("short_words", "try_divide(word_chars, n_words)", 3, 2.2),
    Rule("symbols", "try_divide(n_symbols, n_words)", 0.05, 0.25),
    Rule("symbol_share", "try_divide(n_symbols, word_chars)", 0.01, 0.1),
    Rule("repeated_lines", "try_divide(n_dup_lines, n_lines)", 0.1, 0.4),
    Rule("repeated_words", "try_divide(n_repeat_words, n_words)", 0.15, 0.3),
    Rule("capitals", "try_divide(n_upper, n_letters)", 0.2, 0.5),
    Rule("exclamations", "try_divide(n_exclamations, n_words)", 0.1, 0.5),
    Rule("one_word", "try_divide(n_top_word, n_words)", 0.2, 0.35),
)


@dataclass(frozen=True)
class VoteModel:
    """Share of good texts and, per rule, how often it votes bad on good and on bad texts."""

    good: float
    bad_on_good: tuple[float, ...]
    bad_on_bad: tuple[float, ...]

    def log_odds(self, votes: Sequence[Column]) -> Column:
        total = F.lit(float(np.log(self.good / (1 - self.good))))
        for vote, a, b in zip(votes, self.bad_on_good, self.bad_on_bad):
            against, pro = float(np.log(a / b)), float(np.log((1 - a) / (1 - b)))
            total = total + F.when(vote == -1, against).when(vote == 1, pro).otherwise(0.0)
        return total


def fit_votes(votes: np.ndarray, weight: np.ndarray, rounds: int = 200) -> VoteModel:
    """Expectation-maximisation over distinct vote patterns and their numbers of rows.

    Rules are independent given the class and abstaining says nothing about it. Kinds of bad
    text seldom trip the same rules, so agreement alone could call one kind bad and the rest
    good; the prior therefore holds a rule's errors on good texts below MOST_ERRORS.
    """
    n = votes.shape[1]
    bad, cast = votes == -1, votes != 0
    good, on_good, on_bad = 0.85, np.full(n, MOST_ERRORS / 5), np.full(n, 0.3)
    for _ in range(rounds if weight.sum() else 0):
        odds = np.log(good / (1 - good)) + (
            cast * np.where(bad, np.log(on_good / on_bad), np.log((1 - on_good) / (1 - on_bad)))
        ).sum(axis=1)
        p = weight / (1 + np.exp(-odds))
        q = weight - p
        good = float(np.clip((p.sum() + 8.5) / (weight.sum() + 10), 0.05, 0.99))
        on_good = np.clip((p @ bad + MOST_ERRORS / 5) / (p @ cast + 1), 1e-4, MOST_ERRORS)
        on_bad = np.clip((q @ bad + 0.3) / (q @ cast + 1), 0.02, 0.99)
        on_bad = np.maximum(on_bad, on_good)
    return VoteModel(good, tuple(on_good.tolist()), tuple(on_bad.tolist()))


def judge(documents: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per document: doc_id, COUNTS, base_failed, quality_probability, kept.

    The model is learned from the vote patterns of all documents; there are at most three
    to the number of rules of them, so only that table reaches the driver. Null and empty
    texts have zero counts and fail the base rules; repeated rows and null ids are judged
    one by one; other columns are not read. An empty table gives an empty result. A
    probability of exactly one half is kept.
    """
    spark = documents.sparkSession
    counted = documents.select("doc_id", text_counts(F.col("text")).alias("_c")).select("doc_id", "_c.*")
    counted = stage(counted, scratch_path(spark, "counts"))
    votes = [rule.vote().alias(rule.name) for rule in rules]
    seen = counted.select(*votes).groupBy(*[r.name for r in rules]).agg(F.count("*").alias("_n")).toPandas()
    seen = seen.sort_values([r.name for r in rules])
    model = fit_votes(seen[[r.name for r in rules]].to_numpy(), seen["_n"].to_numpy(dtype=float))
    odds = model.log_odds([rule.vote() for rule in rules])
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return counted.select(
        "doc_id",
        *COUNTS,
        failed.alias("base_failed"),
        (1 / (1 + F.exp(-odds))).alias("quality_probability"),
        (~failed & (odds >= 0)).alias("kept"),
    )
