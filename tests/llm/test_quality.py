from __future__ import annotations

import numpy as np
import pytest
from brute import AWKWARD, base_counts
from brute import SF
from pyspark.sql import functions as F
from zlib import crc32

from eventstrata.llm import quality_trees, weak_rules
from eventstrata.llm.common import least_hashed


def test_rules_counts_and_verdict(spark, documents, texts):
    rows = weak_rules.judge(documents).collect()
    assert len(rows) == len(texts)
    for r in rows:
        counts = base_counts(texts[r["doc_id"]])
        assert counts == (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
        assert r["base_failed"] == failed
        assert r["kept"] == (not failed and r["quality_probability"] >= 0.5)
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"]: r["kept"] for r in rows}
    good = [kept[d] for d, q in quality.items() if q == 1]
    bad = [kept[d] for d, q in quality.items() if q == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.1


def test_rules_awkward_rows(awkward, nothing):
    rows = weak_rules.judge(awkward).collect()
    assert sorted(base_counts(r[1]) for r in AWKWARD) == sorted(
        (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in rows
    )
    assert weak_rules.judge(nothing).count() == 0


def test_votes_recover_planted_accuracies():
    rng = np.random.default_rng(3)
    bad = rng.random(20_000) < 0.15
    votes = np.where(rng.random((20_000, 5)) < np.where(bad[:, None], 0.7, 0.002), -1, 1)
    votes[rng.random(votes.shape) < 0.2] = 0
    patterns, weight = np.unique(votes, axis=0, return_counts=True)
    model = weak_rules.fit_votes(patterns, weight.astype(float))
    assert model.good == pytest.approx(0.85, abs=0.02)
    assert model.bad_on_bad == pytest.approx([0.7] * 5, abs=0.05)


def test_classifier_held_out_accuracy(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = {r["doc_id"]: r for r in quality_trees.score_documents(documents, labels).collect()}
    assert len(scores) == documents.count()
    for d, r in scores.items():
        assert r["held_out"] == (crc32(str(d).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [(r["quality"], scores[r["doc_id"]]) for r in labels.collect() if scores[r["doc_id"]]["held_out"]]
    assert np.mean([q == r["predicted"] for q, r in held]) > 0.95


def test_classifier_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (3, 1, 0), (5, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality_trees.score_documents(awkward, labels).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in rows)
    none = quality_trees.score_documents(awkward, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality_trees.score_documents(nothing, labels).count() == 0
    assert quality_trees.keep_good(awkward, labels.limit(0)).count() == len(AWKWARD)
    assert quality_trees.keep_good(awkward, labels).columns == awkward.columns


def test_flat_forest_equals_node_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 6)).astype(np.float32)
    forest = quality_trees.fit(x, x[:, 0] + x[:, 1] ** 2 > 0.5, trees=10)
    walked = []
    for row in x:
        total = forest.start
        for at in forest.root:
            while forest.left[at] != at:
                at = forest.left[at] if row[forest.feature[at]] <= forest.threshold[at] else forest.right[at]
            total += forest.value[at]
        walked.append(1 / (1 + np.exp(-total)))
    assert forest.score(x) == pytest.approx(walked)


@pytest.mark.parametrize("expected", [0, 5_000, 10**9])
def test_samples_are_the_least_hashes_whatever_is_expected(spark, expected):
    rows = spark.range(5_000).select("id", F.xxhash64("id").alias("by")).cache()
    found = least_hashed(rows, "by", ["id"], 200, expected, "id")
    assert [r["id"] for r in found] == [r["id"] for r in rows.orderBy("by", "id").limit(200).collect()]
