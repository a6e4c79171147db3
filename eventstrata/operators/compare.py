"""Table against table: differences by key and field, membership, fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def field_differences(
    actual: DataFrame, expected: DataFrame, key: str, fields: Sequence[str]
) -> DataFrame:
    """One row per key and field whose values differ, as text; NULL equals NULL.

    A key that one side lacks is told by ``side``; its fields still compare with NULL.
    """
    a, e = actual.alias("a"), expected.alias("e")
    joined = a.join(e, F.col(f"a.{key}") == F.col(f"e.{key}"), "full_outer")
    checks = [
        F.struct(
            F.lit(f).alias("field"),
            F.col(f"e.{f}").cast("string").alias("expected"),
            F.col(f"a.{f}").cast("string").alias("actual"),
            F.col(f"a.{f}").eqNullSafe(F.col(f"e.{f}")).alias("_same"),
        )
        for f in fields
    ]
    side = (
        F.when(F.col(f"a.{key}").isNull(), "expected only")
        .when(F.col(f"e.{key}").isNull(), "actual only")
        .otherwise("both")
    )
    rows = joined.select(
        F.coalesce(f"a.{key}", f"e.{key}").alias(key), side.alias("side"), F.inline(F.array(*checks))
    )
    return rows.where(~F.col("_same")).drop("_same")


def membership_differences(
    actual: DataFrame, expected: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Distinct keys found on one side only.

    Both sides are stacked and grouped, so NULL key parts match and copies combine map-side.
    """
    both = actual.select(*keys, F.lit(1).alias("_a"), F.lit(0).alias("_e")).unionByName(
        expected.select(*keys, F.lit(0).alias("_a"), F.lit(1).alias("_e"))
    )
    seen = both.groupBy(*keys).agg(F.max("_a").alias("_a"), F.max("_e").alias("_e"))
    side = F.when(F.col("_a") == 1, "actual only").otherwise("expected only")
    return seen.where(F.col("_a") != F.col("_e")).select(*keys, side.alias("side"))


def row_number_of(columns: Sequence[str]) -> Column:
    """A number from the text of a row's columns, to be added up over rows.

    Values are separated and NULL has a marker of its own, so no two rows share a text.
    """
    cells = [
        F.coalesce(
            F.concat(F.lit("="), F.replace(F.col(c).cast("string"), F.lit("|"), F.lit("||"))),
            F.lit("~"),
        )
        for c in columns
    ]
    digest = F.md5(F.concat_ws("|", *cells))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(38,0)")


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Row count and an order-free digest sum over the text of every row."""
    total = F.coalesce(F.sum(row_number_of(columns or sorted(df.columns))), F.lit(0))
    return df.agg(
        F.count("*").alias("row_count"), total.cast("string").alias("digest_sum")
    )
