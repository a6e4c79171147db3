"""Fingerprint trees: one changed row is found, and only its bucket is read."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from eventstrata.operators.compare import field_differences
from eventstrata.operators.prints import LEAF, PrintedTable, differing_leaves, printed_differences
from eventstrata.session import scratch_path


def table(spark, rows, bits=7):
    printed = PrintedTable(spark, scratch_path(spark, "printed"), "k", bits)
    printed.write(rows)
    return printed


@pytest.fixture(scope="module")
def orders(spark):
    k = F.when(F.col("id") == 13, None).otherwise(F.concat(F.lit("o"), "id"))
    return spark.range(3000).select(k.alias("k"), (F.col("id") % 9).alias("v"), F.lit("x").alias("w"))


@pytest.fixture(scope="module")
def stored(spark, orders):
    return table(spark, orders)


@pytest.mark.parametrize("key", ["o1234", None])
def test_one_changed_row_prunes_all_other_buckets(spark, orders, stored, key):
    changed = F.col("k").eqNullSafe(F.lit(key))
    other = table(spark, orders.withColumn("v", F.when(changed, -1).otherwise(F.col("v"))))
    leaves = differing_leaves(other, stored)
    wanted = orders.where(changed).select(stored.leaf()).first()[0]
    assert leaves == [wanted]
    found = printed_differences(other, stored, ["v", "w"])
    text = found._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(rf"PartitionFilters: \[[^\]]*{LEAF}#\d+ (?:IN|=) \(?{wanted}\)?", text)) == 2
    read = {r[0] for r in stored.rows(leaves).select(F.col("_metadata.file_path")).distinct().collect()}
    assert all(f"{LEAF}={wanted}/" in path for path in read)
    rows = [tuple(r) for r in found.collect()]
    if key:
        assert rows == [(key, "both", "v", str(1234 % 9), "-1")]
    else:
        # As in any join, a NULL key meets no other: each side is told alone.
        assert [r[0] for r in rows] == [None] * 4


def test_same_result_as_the_whole_join(spark, orders, stored):
    other = orders.where("k is null or k <> 'o5'").withColumn("w", F.when(F.col("v") == 3, None).otherwise("x"))
    other = other.unionByName(spark.createDataFrame([("new", 1, "y")], orders.schema))
    found = printed_differences(table(spark, other), stored, ["v", "w"])
    whole = field_differences(other, orders, "k", ["v", "w"])
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))


def test_equal_and_empty_tables(spark, orders, stored):
    assert differing_leaves(table(spark, orders.orderBy("v")), stored) == []
    assert printed_differences(stored, stored, ["v"]).count() == 0
    few = table(spark, orders.limit(1))
    assert len(differing_leaves(few, stored)) >= 100
    with pytest.raises(ValueError, match="cut alike"):
        differing_leaves(stored, PrintedTable(spark, stored.path, "k", 3))


def test_tree_levels_add_up(stored):
    assert stored.prints(0).first()["rows"] == 3000
    for bits in (3, 7):
        level = stored.prints(bits).collect()
        assert len(level) <= 2**bits and sum(r["rows"] for r in level) == 3000
