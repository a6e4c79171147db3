"""Tables in hash buckets with a stored tree of fingerprints: compare what differs, skip the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventstrata.operators.compare import field_differences, row_number_of

LEAF = "_leaf"


class PrintedTable:
    """A table below ``path`` in 2 ** bits buckets of its key, one folder each.

    Every bucket has a fingerprint: its row count and the sum of its rows' digests, which
    adds up over buckets. So a node of the tree over the buckets' bits is the sum of its
    leaves, no order matters, and two tables are compared from the root down without reading
    a row. NULL keys are in one bucket and compare like any other.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, bits: int = 10):
        if not 1 <= bits <= 16:
            raise ValueError(f"between 1 and 16 bits, got {bits}")
        self.spark, self.path, self.key, self.bits = spark, path.rstrip("/"), key, bits

    def leaf(self) -> Column:
        return F.shiftrightunsigned(F.xxhash64(self.key), 64 - self.bits).cast("int")

    def write(self, rows: DataFrame, compression: str = "zstd") -> None:
        """Replace the table; its prints are taken from what was written."""
        (
            rows.withColumn(LEAF, self.leaf())
            .repartitionByRange(LEAF, self.key)
            .sortWithinPartitions(LEAF, self.key)
            .write.mode("overwrite")
            .option("compression", compression)
            .partitionBy(LEAF)
            .parquet(f"{self.path}/rows")
        )
        stored = self._stored()
        cells = row_number_of(sorted(c for c in stored.columns if c != LEAF))
        prints = stored.groupBy(LEAF).agg(F.count("*").alias("rows"), F.sum(cells).alias("digest"))
        prints.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/prints")

    def _stored(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def rows(self, leaves: Sequence[int] | None = None) -> DataFrame:
        """All rows, or those of some leaves: other folders are pruned before any read."""
        stored = self._stored()
        return (stored if leaves is None else stored.where(F.col(LEAF).isin(list(leaves)))).drop(LEAF)

    def prints(self, bits: int) -> DataFrame:
        """node, rows, digest of the tree's level with 2 ** bits nodes."""
        stored = self.spark.read.parquet(f"{self.path}/prints")
        node = F.shiftright(LEAF, self.bits - bits).alias("node")
        return stored.groupBy(node).agg(F.sum("rows").alias("rows"), F.sum("digest").alias("digest"))


def differing_leaves(actual: PrintedTable, expected: PrintedTable, step: int = 4) -> list[int]:
    """Leaves whose fingerprints differ, found from the root down, ``step`` bits at a time.

    Only children of nodes that differ are looked at. Prints alone are read; at most the
    differing nodes of a level, and so never more than the buckets, come to the driver.
    """
    if (actual.key, actual.bits) != (expected.key, expected.bits):
        raise ValueError("tables must be cut alike")
    level, open_nodes = 0, [0]
    while True:
        a, e = (
            t.prints(level).where(F.col("node").isin(open_nodes)).select("node", F.struct("rows", "digest").alias(side))
            for t, side in ((actual, "a"), (expected, "e"))
        )
        both = a.join(e, "node", "full_outer").where(~F.col("a").eqNullSafe(F.col("e")))
        found = sorted(r["node"] for r in both.select("node").collect())
        if not found or level == actual.bits:
            return found
        down = min(step, actual.bits - level)
        level += down
        open_nodes = [n << down | child for n in found for child in range(1 << down)]


def printed_differences(actual: PrintedTable, expected: PrintedTable, fields: Sequence[str]) -> DataFrame:
    """``field_differences`` of two printed tables, joining only the buckets that differ."""
    leaves = differing_leaves(actual, expected)
    return field_differences(actual.rows(leaves), expected.rows(leaves), actual.key, fields)
