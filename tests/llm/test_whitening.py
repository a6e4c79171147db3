from __future__ import annotations

from math import floor

import numpy as np
import pytest
from brute import SF

from eventstrata.llm import dense, whitening
from eventstrata.llm.queries import REGISTRY

SCHEMA = "vec_id long, embedding array<double>, n long, component int, part string"


def plain(vectors, components=8):
    """(whitened, deviation, explained) by the textbook: covariance, eigenvectors."""
    x = np.array([[floor(1024 * c) + 100_000 for c in v] for v in vectors], dtype=float)
    n = len(x)
    sums = [sum(floor(1024 * c) + 100_000 for c in column) for column in zip(*vectors)]
    deviation = [sum((n * (floor(1024 * c) + 100_000) - s) ** 2 for c, s in zip(v, sums)) for v in vectors]
    y = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(y.T @ y / n)
    order = values.argsort()[::-1][:components]
    return y @ axes[:, order] / np.sqrt(values[order]), deviation, values[order] / values.sum()


def compare(rows, vectors, ids, components=8, tolerance=1e-8):
    white, deviation, share = plain(vectors, components)
    place = {name: i for i, name in enumerate(ids)}
    got = np.full(white.shape, np.nan)
    for r in rows:
        i, k = place[r["vec_id"]], r["component"] - 1
        got[i, k] = r["whitened"]
        assert r["n"] == len(vectors)
        assert r["deviation"] == (deviation[i] if deviation[i] < 2**63 else None)
        assert r["explained"] == pytest.approx(share[k], rel=1e-9)
        assert r["identity_error"] < 1e-9
    sign = np.sign((got * white).sum(axis=0))
    assert np.abs(got * sign - white).max() < tolerance


def test_query_equals_covariance_eigenvectors(spark):
    rows = REGISTRY["op13_embedding_whitening"](spark, SF).collect()
    source = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    kept = [r for r in source if r["embedding"] is not None and all(c is not None and np.isfinite(c) for c in r["embedding"])]
    assert len(rows) == 8 * len(kept)
    compare(rows, [r["embedding"] for r in kept], [r["vec_id"] for r in kept])


def test_left_out_rows_and_clashing_columns(spark):
    rng = np.random.default_rng(3)
    good = rng.normal(size=(60, 4)).tolist()
    odd = [None, [], [None, 1.0, 1.0, 1.0], [float("nan")] * 4, [float("inf")] * 4, [1e300] * 4, [1.0, 2.0]]
    rows = [(i, v, 1, 2, "x") for i, v in enumerate([*good, *odd])]
    table = spark.createDataFrame(rows, SCHEMA)
    got = whitening.whiten(table).collect()
    assert {r["vec_id"] for r in got} == set(range(60)) and len(got) == 240
    compare(got, good, range(60), components=4)


def test_repeated_rows_and_null_ids_stay(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(20, 3)).tolist()
    rows = [(i, v, 1, 1, "") for i, v in enumerate(vectors)] + [(0, vectors[0], 1, 1, ""), (None, vectors[1], 1, 1, "")]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 22 * 3
    assert sum(r["vec_id"] == 0 for r in got) == 6 and sum(r["vec_id"] is None for r in got) == 3


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [None], [[]]])
def test_no_spread_no_rows(spark, vectors):
    table = spark.createDataFrame([(i, v, 1, 1, "") for i, v in enumerate(vectors)], SCHEMA)
    got = whitening.whiten(table)
    assert got.collect() == []
    assert got.columns[:3] == ["vec_id", "component", "n"]


def test_dependent_dimensions_and_wide_range(spark):
    """Rank two in five dimensions, one of them constant; spreads from 1 to 100,000."""
    rng = np.random.default_rng(5)
    a, b = rng.integers(-1000, 1000, 80), rng.integers(-100_000, 100_000, 80) * 1000
    vectors = [[x / 1024, y / 1024, (x + y) / 1024, 0.5, -x / 1024] for x, y in zip(a.tolist(), b.tolist())]
    got = whitening.whiten(spark.createDataFrame([(i, v, 1, 1, "") for i, v in enumerate(vectors)], SCHEMA)).collect()
    assert {r["component"] for r in got} == {1, 2}
    compare(got, vectors, range(80), components=2, tolerance=1e-6)


def test_ill_conditioned_small_component(spark):
    """Two dimensions that differ by one part in ten million still give a unit covariance."""
    rng = np.random.default_rng(6)
    a = rng.integers(-(10**9), 10**9, 200)
    vectors = [[x / 1024, (x + int(e)) / 1024] for x, e in zip(a.tolist(), rng.integers(-50, 50, 200))]
    got = whitening.whiten(spark.createDataFrame([(i, v, 1, 1, "") for i, v in enumerate(vectors)], SCHEMA)).collect()
    assert {r["component"] for r in got} == {1, 2}
    assert all(r["identity_error"] < 1e-4 for r in got)


def test_large_numbers_are_exact_or_null(spark):
    huge = [[float(2**50) * i, float(i * i)] for i in range(6)]
    got = whitening.whiten(spark.createDataFrame([(i, v, 1, 1, "") for i, v in enumerate(huge)], SCHEMA)).collect()
    assert got and all(r["deviation"] is None for r in got)
    near = [[float(2**17) * i, float(i * i)] for i in range(6)]
    got = whitening.whiten(spark.createDataFrame([(i, v, 1, 1, "") for i, v in enumerate(near)], SCHEMA)).collect()
    assert {r["vec_id"]: r["deviation"] for r in got} == dict(enumerate(plain(near)[1]))


def test_tree_sum_adds_over_several_levels(spark):
    def part(batches):
        list(batches)
        number = dense.part_number()
        yield dense.rows_of(np.array([0, 7]), number, np.array([[1, number], [2, 3]]))

    parts = spark.range(40).repartition(11).mapInArrow(part, dense.schema("long"))
    got = {r["block"]: r["values"] for r in dense.tree_sum(parts, "long", fan=3).collect()}
    assert got == {0: [11, 55], 7: [22, 33]}
