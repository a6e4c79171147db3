"""Nearest neighbours by stable projections, a kd-tree and a chi-square stopping test."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush
from math import exp, inf

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventstrata.llm.common import group_starts, least_hashed, numbers, whole_groups
from eventstrata.session import scratch_path, stage


@dataclass(frozen=True)
class Search:
    k: int = 10
    projections: int = 8  # even, for the closed form of the chi-square distribution
    confidence: float = 0.995
    bucket: int = 256  # vectors per kd-tree leaf
    block: int = 20_000  # vectors that one task indexes at once
    queries: int = 2_000  # queries that meet one block in one task
    max_regions: int = 4096  # regions of the coarse tree, which every task holds
    sample: int = 20_000  # projected rows that the coarse tree is fitted on
    seed: int = 7


def chi_square(x: float, degrees: int) -> float:
    """Distribution function for even degrees of freedom."""
    if x == inf:
        return 1.0
    half, term, total = x / 2, 1.0, 0.0
    for i in range(degrees // 2):
        total += term
        term *= half / (i + 1)
    return 1 - exp(-half) * total


def quantile(share: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, degrees) < share else (low, mid)
    return high


class KdTree:
    """Median splits on the widest side down to buckets; nodes keep their bounding boxes.

    ``order`` lists the points so that every bucket is a slice of it.
    """

    def __init__(self, points: np.ndarray, bucket: int):
        self.order = np.arange(len(points))
        self.slice: list[tuple[int, int]] = []
        self.child: list[tuple[int, int]] = []
        low, high = [], []
        todo = [(0, len(points), -1, 0)]
        while todo:
            lo, hi, parent, side = todo.pop()
            at, box = len(self.slice), points[self.order[lo:hi]]
            low.append(box.min(axis=0))
            high.append(box.max(axis=0))
            self.slice.append((lo, hi))
            self.child.append((-1, -1))
            if parent >= 0:
                pair = list(self.child[parent])
                pair[side] = at
                self.child[parent] = (pair[0], pair[1])
            width = high[at] - low[at]
            if hi - lo <= bucket or not width.max() > 0:
                continue
            middle = (hi - lo) // 2
            self.order[lo:hi] = self.order[lo:hi][np.argpartition(box[:, int(width.argmax())], middle)]
            todo += [(lo, lo + middle, at, 0), (lo + middle, hi, at, 1)]
        self.low, self.high = np.array(low), np.array(high)

    def outside(self, nodes: list[int] | np.ndarray, point: np.ndarray) -> np.ndarray:
        """Squared distance from a point to the boxes of nodes."""
        gap = np.maximum(np.maximum(self.low[nodes] - point, point - self.high[nodes]), 0)
        return (gap * gap).sum(axis=1)


def rounding(point: np.ndarray) -> float:
    """Squared projected distances up to this may be rounding alone."""
    return 1e-20 * float(point @ point)


def nearest(
    tree: KdTree, ids: np.ndarray, vectors: np.ndarray, projected: np.ndarray, query: tuple, how: Search
) -> list[tuple[float, int]]:
    """The k nearest (distance, id) found, ties to the smaller id; rows are in tree order.

    Buckets come by projected distance; their vectors are verified with the true distance.
    The projected square of a vector at true distance r is r squared times a chi-square
    value, so the search ends once the next projected distance would belong to a vector
    closer than the k-th best with a probability below 1 - confidence. Equal vectors may
    differ in the last bits of their projections, so distances have a slack for rounding.
    """
    own, vector, point, radius = query
    limit = quantile(how.confidence, how.projections)
    slack = rounding(point)
    best: list[tuple[float, int]] = []
    reach = radius * radius
    heap = [(float(tree.outside([0], point)[0]), 0)]
    while heap:
        away, node = heappop(heap)
        if away > limit * reach + slack:
            break
        if tree.child[node][0] >= 0:
            pair = list(tree.child[node])
            for child, distance in zip(pair, tree.outside(pair, point).tolist()):
                heappush(heap, (distance, child))
            continue
        rows = slice(*tree.slice[node])
        gap = projected[rows] - point
        near = np.einsum("ij,ij->i", gap, gap) <= limit * reach + slack
        gap = vectors[rows] - vector
        square = np.einsum("ij,ij->i", gap, gap)
        near &= ids[rows] != own
        if len(best) == how.k:
            near &= square <= best[-1][0]
        if near.any():
            best = sorted({*best, *zip(square[near].tolist(), ids[rows][near].tolist())})[: how.k]
            if len(best) == how.k:
                reach = min(reach, best[-1][0])
    return [(float(np.sqrt(s)), i) for s, i in best]


def usable(vector: Column) -> Column:
    """Neither null nor zero, every component a finite number."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~wrong & F.exists(vector, lambda x: x != 0)


def _matrix(rows: pa.RecordBatch | pa.Table, name: str, width: int) -> np.ndarray:
    column = rows.column(name)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


class Regions:
    """A coarse kd-tree over the projected space; its leaves are regions of all rows."""

    def __init__(self, sample: np.ndarray, count: int):
        self.feature, self.cut, self.left, self.right, self.leaf = [], [], [], [], []
        self.count = 0
        todo = [(sample, count, -1, 0)]
        while todo:
            points, share, parent, side = todo.pop()
            at = len(self.feature)
            for values, value in zip((self.feature, self.cut, self.left, self.right, self.leaf), (0, inf, at, at, -1)):
                values.append(value)
            if parent >= 0:
                (self.right if side else self.left)[parent] = at
            spread = np.ptp(points, axis=0) if len(points) > 1 else np.zeros(1)
            if share < 2 or not spread.max() > 0:
                self.leaf[at] = self.count
                self.count += 1
                continue
            axis = int(spread.argmax())
            cut = float(np.median(points[:, axis]))
            low = points[:, axis] <= cut
            if low.all():
                cut = float(points[points[:, axis] < cut, axis].max())
                low = points[:, axis] <= cut
            self.feature[at], self.cut[at] = axis, cut
            todo += [(points[low], share // 2, at, 0), (points[~low], share - share // 2, at, 1)]
        self.arrays = [np.array(x) for x in (self.feature, self.cut, self.left, self.right, self.leaf)]

    def of(self, points: np.ndarray) -> np.ndarray:
        feature, cut, left, right, leaf = self.arrays
        at = np.zeros(len(points), dtype=int)
        while (leaf[at] < 0).any():
            at = np.where(points[np.arange(len(points)), feature[at]] <= cut[at], left[at], right[at])
        return leaf[at].astype(np.int32)


TASK = ["region", "salt", "chunk"]


def _search_blocks(width: int, how: Search, directions: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, TASK):
            starts = group_starts(table, TASK)
            ids, radius = numbers(table, "vec_id"), numbers(table, "radius")
            asked = numbers(table, "is_query").astype(bool)
            vectors = _matrix(table, "vector", width)
            projected = vectors @ directions
            out = []
            for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)]):
                rows = np.arange(s, e)
                data, queries = rows[~asked[s:e]], rows[asked[s:e]]
                if not len(data):
                    continue
                tree = KdTree(projected[data], how.bucket)
                data = data[tree.order]
                block = (ids[data], vectors[data], projected[data])
                for q in queries.tolist():
                    query = (ids[q], vectors[q], projected[q], radius[q])
                    for score, found in nearest(tree, *block, query, how):
                        out.append((int(ids[q]), int(found), score))
            columns = list(zip(*out)) if out else [[], [], []]
            types = (pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["query_id", "vec_id", "score"]
            )

    return run


FOUND = "query_id long, vec_id long, score double"


def _meet(rows: DataFrame, visits: DataFrame, width: int, how: Search, directions: np.ndarray) -> DataFrame:
    """Search every visited block. Blocks and their queries are both cut to bounded chunks."""
    load = visits.groupBy("region").agg(F.count("*").alias("n"))
    load = load.select("region", F.ceil(F.col("n") / how.queries).cast("int").alias("chunks"))
    chunk = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    data = rows.join(load, "region").select(
        "region", "salt", chunk, F.lit(False).alias("is_query"), "vec_id", "vector", F.lit(0.0).alias("radius")
    )
    asked = visits.join(load, "region").select(
        "region",
        "salt",
        F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int").alias("chunk"),
        F.lit(True).alias("is_query"),
        "vec_id",
        "vector",
        "radius",
    )
    dealt = data.unionByName(asked).repartition(*TASK).sortWithinPartitions(*TASK, "is_query", "vec_id")
    return dealt.mapInArrow(_search_blocks(width, how, directions), FOUND)


def nearest_neighbours(
    embeddings: DataFrame, is_query: Column, how: Search = Search(), vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found to every query row.

    Score is the Euclidean distance in double precision on the original vectors; ties go to
    the smaller id. Every row is indexed: a coarse kd-tree, fitted on a bounded sample of
    projections, deals rows to regions, large regions are salted into blocks, and each
    block has a kd-tree of its own. A query first searches one block of its own region,
    which bounds its radius, then all regions whose boxes pass the chi-square test with it.

    Vectors that are null, zero, hold null or non-finite components, or are not as long as
    most vectors take no part, nor do null ids. Rows with the query's id are its own and no
    candidates; a query id that occurs twice is searched by one of its vectors; a candidate
    id that occurs twice counts by its nearest vector. Other columns are not read. An empty
    table gives an empty result.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    ).where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.desc("n"), "width").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, total = common["width"], common["n"]
    rows = rows.where(F.size("vector") == width)
    directions = np.random.default_rng(how.seed).standard_normal((width, how.projections))

    hashed = rows.select(F.xxhash64("vec_id").alias("by"), "vec_id", "vector")
    sampled = least_hashed(hashed, "by", ["vec_id"], how.sample, total, "vector")
    points = np.array([r["vector"] for r in sampled], dtype=float).reshape(-1, width) @ directions
    regions = Regions(points, min(how.max_regions, -(-total // how.block)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            projected = _matrix(batch, "vector", width) @ directions
            fields = [pa.array(regions.of(projected), pa.int32()), pa.array(list(projected), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *fields], names=[*batch.schema.names, "region", "point"])

    placed = rows.mapInArrow(place, "vec_id long, vector array<double>, is_query boolean, region int, point array<double>")
    placed = stage(placed, scratch_path(spark, "projected"))
    sides = [f(F.col("point")[i]).alias(f"{n}{i}") for i in range(how.projections) for n, f in (("l", F.min), ("h", F.max))]
    boxes = placed.groupBy("region").agg(F.count("*").alias("n"), *sides).toPandas().sort_values("region")
    salts = -(-boxes["n"].to_numpy() // how.block)
    low = boxes[[f"l{i}" for i in range(how.projections)]].to_numpy()
    high = boxes[[f"h{i}" for i in range(how.projections)]].to_numpy()
    names = boxes["region"].to_numpy()
    limit = quantile(how.confidence, how.projections)

    counts = spark.createDataFrame(list(zip(names.tolist(), salts.tolist())), "region int, salts int")
    salt = F.pmod(F.xxhash64("vec_id"), F.col("salts")).cast("int").alias("salt")
    dealt = placed.join(F.broadcast(counts), "region").select("*", salt).drop("salts")
    queries = dealt.where("is_query").dropDuplicates(["vec_id"])
    home = queries.select("region", "salt", "vec_id", "vector", F.lit(inf).alias("radius"))
    first = _meet(dealt.select("region", "salt", "vec_id", "vector"), home, width, how, directions)
    first = stage(first, scratch_path(spark, "first-finds"))
    reached = first.groupBy(F.col("query_id").alias("vec_id")).agg(
        F.when(F.count_distinct(F.col("vec_id")) >= how.k, F.max("score")).alias("radius")
    )
    bounded = queries.select("vec_id", "vector", "point").join(reached, "vec_id", "left")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            point = _matrix(batch, "point", how.projections)
            radius = np.nan_to_num(numbers(batch, "radius").astype(float), nan=inf)
            row, region, part = [], [], []
            for i in range(len(point)):
                gap = np.maximum(np.maximum(low - point[i], point[i] - high), 0)
                near = np.flatnonzero((gap * gap).sum(axis=1) <= limit * radius[i] ** 2 + rounding(point[i]))
                for r in near.tolist():
                    for s in range(salts[r]):
                        row.append(i)
                        region.append(int(names[r]))
                        part.append(s)
            picked = batch.select(["vec_id", "vector"]).take(pa.array(row, pa.int64()))
            more = [pa.array(region, pa.int32()), pa.array(part, pa.int32()), pa.array(radius[row], pa.float64())]
            yield pa.RecordBatch.from_arrays([*picked.columns, *more], names=["vec_id", "vector", "region", "salt", "radius"])

    visits = bounded.mapInArrow(route, "vec_id long, vector array<double>, region int, salt int, radius double")
    visits = stage(visits, scratch_path(spark, "visits"))
    found = _meet(dealt.select("region", "salt", "vec_id", "vector"), visits, width, how, directions)
    # What the first pass found stays a candidate.
    found = found.unionByName(first).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= how.k)
    return ranked.select("query_id", "rank", "vec_id", "score")
