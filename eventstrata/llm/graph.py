"""Connected components over links that do not fit one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from eventstrata.session import reread, scratch_path

MAX_ROUNDS = 60


def _stage_with_digest(links: DataFrame) -> tuple[DataFrame, tuple]:
    """Write the links once; the same write yields their number and an order-free digest."""
    seen = Observation()
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    path = scratch_path(links.sparkSession, "links")
    links.observe(seen, F.count("*").alias("n"), digest.alias("d")).write.parquet(path)
    return reread(links, path), (seen.get["n"], seen.get["d"])


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    joined = both.join(least, "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v): root is the component's smallest node.

    Alternating large and small stars: each round replaces links by links to the smallest
    neighbour and at least halves the distances, so rounds grow with the logarithm of a
    component's diameter. A hub's links are only ever joined (splittable) or aggregated
    (combined before the shuffle). Links with equal or null ends are ignored; no link,
    no row. Roots have a row of their own.
    """
    links = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current, before = _stage_with_digest(links.distinct())
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        current, now = _stage_with_digest(_small_star(_large_star(current)))
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
