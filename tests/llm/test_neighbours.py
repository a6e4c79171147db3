from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventstrata.llm import neighbours
from eventstrata.llm.neighbours import KdTree, Regions, Search, chi_square, nearest, nearest_neighbours, quantile

def query():
    return F.col("vec_id") % 100 == 0


def brute(rows, k=10):
    ids, vectors = zip(*sorted(rows.items()))
    ids, vectors = np.array(ids), np.array(vectors, dtype=float)
    out = {}
    for q in ids[ids % 100 == 0]:
        far = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, far)) if ids[i] != q][:k]
        out[int(q)] = [(int(ids[i]), far[i]) for i in order]
    return out


def test_chi_square_closed_form():
    assert chi_square(quantile(0.95, 8), 8) == pytest.approx(0.95)
    assert quantile(0.95, 2) == pytest.approx(-2 * np.log(0.05))


def test_tree_buckets_cover_all_points():
    points = np.random.default_rng(1).normal(size=(1000, 4))
    tree = KdTree(points, 32)
    leaves = [s for s, c in zip(tree.slice, tree.child) if c[0] < 0]
    assert sorted(i for lo, hi in leaves for i in tree.order[lo:hi]) == list(range(1000))


def test_regions_place_every_point():
    points = np.random.default_rng(2).normal(size=(500, 4))
    regions = Regions(points, 7)
    assert set(regions.of(points).tolist()) == set(range(regions.count))
    assert Regions(np.zeros((50, 4)), 7).count == 1


@pytest.mark.parametrize("how", [Search(), Search(block=60, queries=2)])
def test_recall(spark, how):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    expected = brute({r["vec_id"]: r["embedding"] for r in table.collect()})
    got = {}
    for r in nearest_neighbours(table, query(), how).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got.keys() == expected.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert hits >= 0.9 * sum(map(len, expected.values()))
    assert all(len(got[q]) == 10 for q in got)


def test_ties_copies_and_unusable_vectors(spark):
    same = [0.5, 1.0, -2.0, 4.0]
    rows = [(i, same, "x") for i in range(0, 330, 3)]
    rows += [(1, None, "x"), (2, [0.0] * 4, "x"), (4, [1.0, None, 1.0, 1.0], "x"), (5, [float("nan")] * 4, "x")]
    rows += [(7, [float("inf"), 1.0, 1.0, 1.0], "x"), (8, [1.0, 2.0], "x"), (None, same, "x"), (3, same, "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, region string")
    for how in (Search(k=4), Search(k=4, block=20)):
        got = nearest_neighbours(table, query(), how).orderBy("query_id", "rank").collect()
        assert [r["vec_id"] for r in got if r["query_id"] == 0] == [3, 6, 9, 12]
        assert [r["vec_id"] for r in got if r["query_id"] == 300] == [0, 3, 6, 9]
        assert {r["score"] for r in got} == {0.0}


def test_copies_whose_projections_differ_in_the_last_bits():
    rng = np.random.default_rng(4)
    vectors = np.repeat(rng.normal(size=(1, 64)), 40, axis=0)
    directions = rng.normal(size=(64, 8))
    projected = vectors @ directions
    # As products of other sizes give them.
    query = np.nextafter(projected[0], np.inf)
    how = Search()
    tree = KdTree(projected, how.bucket)
    ids = np.arange(40)[tree.order]
    for radius in (0.0, np.inf):
        got = nearest(tree, ids, vectors[tree.order], projected[tree.order], (7, vectors[0], query, radius), how)
        assert got == [(0.0, i) for i in range(11) if i != 7]


def test_finds_of_the_first_pass_stay(spark, monkeypatch):
    # A second pass that finds nothing must not take away what the first one found.
    rows = [(i, [0.5, 1.0, -2.0, 4.0]) for i in range(0, 330, 3)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    meet, calls = neighbours._meet, []

    def once(*args):
        calls.append(1)
        found = meet(*args)
        return found if len(calls) == 1 else found.limit(0)

    monkeypatch.setattr(neighbours, "_meet", once)
    got = nearest_neighbours(table, query(), Search(k=4)).orderBy("query_id", "rank").collect()
    assert [r["vec_id"] for r in got if r["query_id"] == 300] == [0, 3, 6, 9]


def test_few_and_no_rows(spark):
    table = spark.createDataFrame([(100, [1.0, 2.0]), (1, [1.0, 4.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in nearest_neighbours(table, query()).collect()] == [(100, 1, 1, 2.0)]
    empty = nearest_neighbours(table.limit(0), query())
    assert empty.columns == ["query_id", "rank", "vec_id", "score"] and empty.count() == 0


def test_extra_columns_with_the_operators_own_names(spark):
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(60, 4)).tolist()
    plain_rows = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    extra = plain_rows.selectExpr("*", "'x' AS region", "1 AS salt", "2D AS radius", "array(1D) AS point", "true AS is_query", "7 AS by")
    want = nearest_neighbours(plain_rows, query(), Search(k=3)).orderBy("query_id", "rank").collect()
    got = nearest_neighbours(extra, query(), Search(k=3)).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want] and want
