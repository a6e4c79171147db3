"""Every registered query against its SQL, run by DuckDB over the same tables."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from eventstrata.catalog.queries import REGISTRY
from helpers import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.001"
# Rows never pass through Python, and no join pairs everything with everything.
FORBIDDEN = ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin")


def tables(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS FROM '{file}'")
    return con


@pytest.fixture(scope="module")
def duck():
    return tables(SF_DIR)


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(canonical(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(cells, key=repr)


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(driver.oracle_sql())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(name, spark, duck):
    actual = driver.queries()[name](spark, SF_DIR)
    plan = actual._jdf.queryExecution().executedPlan().toString()
    for operator in FORBIDDEN:
        assert operator not in plan
    expected = duck.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    want = table(columns, expected.fetchall())
    got = table(actual.columns, [tuple(r) for r in actual.collect()])
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_percentiles_stay_exact_with_many_rows_per_type(spark):
    sf_dir = f"{TESTDATA}/sf0.1"
    rows = REGISTRY["lateness_percentiles"](spark, sf_dir).orderBy("event_type").collect()
    expected = tables(sf_dir).execute(driver.oracle_sql()["lateness_percentiles"]).df()
    expected = expected.sort_values("event_type")[rows[0].__fields__]
    assert [tuple(r) for r in rows] == [tuple(r) for r in expected.itertuples(index=False)]
    assert max(r["events"] for r in rows) > 10_000
