"""Validity, extraction, trimming and time parsing on literal texts."""

from __future__ import annotations

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from eventstrata.functions.rates import safe_rate
from eventstrata.functions.text import blank_to_null, is_blank, strip_carriage_returns
from eventstrata.functions.times import parse_utc, seconds_between
from helpers import bronze

VALID = [
    '{"event_id":"x"}',
    "[1,2]",
    "123",
    '"s"',
    "null",
    "{}",
    ' {"event_id":"x"} ',
    '{"event_id":"x","event_id":"y"}',
    '{"event_id":{"a":[1,{"b":2}]}}',
]
INVALID = [
    '{"event_id":"x"} junk',
    '{"event_id":"x"}{"a":1}',
    '{"event_id":"x"}, {"a":1}',
    '{"event_id":"x"}]',
    '{"event_id":"x"}}',
    "{'event_id':'x'}",
    '{"event_id":"x"',
    '1,"x":2',
    '1}],[{"z":1',
    "bad",
    '{"a":01}',
    '{"a":"\t"}',
]


def test_json_validity(spark):
    rows = bronze(spark, *VALID, *INVALID).orderBy("_source_row").collect()
    assert [r["_is_valid_json"] for r in rows] == [True] * len(VALID) + [False] * len(INVALID)


def test_json_validity_agrees_with_duckdb(spark):
    rows = bronze(spark, *VALID, *INVALID).select("_raw_payload", "_is_valid_json", "event_id")
    con = duckdb.connect()
    for text, ok, event_id in rows.collect():
        assert con.execute("SELECT json_valid(?)", [text]).fetchone()[0] == ok
        if ok:
            sql = "SELECT json_extract_string(?, '$.event_id')"
            found = con.execute(sql, [text]).fetchone()[0]
            assert (found or "").replace(" ", "") == (event_id or "").replace(" ", "")


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('{"event_id":"x","event_id":"y"}', "x"),
        ('{"event_id":1.0}', "1.0"),
        ('{"event_id":7}', "7"),
        ('{"event_id":true}', "true"),
        ('{"event_id":null}', None),
        ('{"other":1}', None),
        ('["event_id"]', None),
        ('{"event_id":"x"', None),
        ('{"event_id":"\\u00e9"}', "é"),
    ],
)
def test_field_text(spark, text, expected):
    assert bronze(spark, text).first()["event_id"] == expected


TIMES = {
    "2026-09-03T10:04:11Z": dt.datetime(2026, 9, 3, 10, 4, 11),
    "2026-09-03T10:04:11.123456789Z": dt.datetime(2026, 9, 3, 10, 4, 11, 123456),
    "2026-09-03T10:04:11+05:30": dt.datetime(2026, 9, 3, 4, 34, 11),
    "2026-09-03T10:04:11+0530": dt.datetime(2026, 9, 3, 4, 34, 11),
    "2026-09-03T10:04:11 Europe/Berlin": dt.datetime(2026, 9, 3, 8, 4, 11),
    "2026-09-03T10:04Z": dt.datetime(2026, 9, 3, 10, 4),
    "2026-09-03 10:04": dt.datetime(2026, 9, 3, 10, 4),
    "2026-09-03  10:04:11": dt.datetime(2026, 9, 3, 10, 4, 11),
    "2026-09-03": dt.datetime(2026, 9, 3),
    "2026/09/03 10:04:11": dt.datetime(2026, 9, 3, 10, 4, 11),
    "2026-09-03T24:00:00Z": dt.datetime(2026, 9, 4),
    "2026-09-03T24:00:01Z": None,
    "2026-02-30T00:00:00Z": None,
    "2026-09-03T10": None,
    "2026-09-03T10:04:11 Z": None,
    "2026-09-03T10:04:11+5": None,
    "now": None,
    "today": None,
    "10:04:11": None,
    "T10:04:11Z": None,
    "2026": None,
    "2026-09": None,
    "not-a-timestamp": None,
    "": None,
}


def test_parse_utc(spark):
    rows = spark.createDataFrame([(t,) for t in TIMES], "t string")
    got = {r.t: r.v for r in rows.select("t", parse_utc(F.col("t")).alias("v")).collect()}
    assert got == TIMES


def test_parse_utc_agrees_with_duckdb(spark):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    sql = "SELECT try_cast(? AS TIMESTAMPTZ)::TIMESTAMP"
    assert {t: con.execute(sql, [t]).fetchone()[0] for t in TIMES} == TIMES


@pytest.mark.parametrize(
    ("start", "end", "seconds"),
    [
        ("00:00:00.000", "00:05:00.500", 300),
        ("00:00:00.100", "00:05:01.050", 301),
        ("00:05:00.100", "00:00:00.900", -300),
        ("00:00:00.999", "00:00:01.000", 1),
    ],
)
def test_seconds_between(spark, start, end, seconds):
    moments = [F.lit(f"2026-09-03 {x}").cast("timestamp_ntz") for x in (start, end)]
    assert spark.range(1).select(seconds_between(*moments)).first()[0] == seconds


def test_blank_and_padding(spark):
    texts = [" \u00a0x\u2003", "  ", "\u00a0", "", "\t", " a b "]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = rows.select("i", blank_to_null(F.col("t")).alias("v"), is_blank(F.col("t")).alias("b"))
    assert [tuple(r)[1:] for r in got.orderBy("i").collect()] == [
        ("x", False),
        (None, True),
        (None, True),
        (None, True),
        ("\t", False),
        ("a b", False),
    ]


def test_carriage_returns(spark):
    rows = spark.createDataFrame([("\r\ra\rb\r",), ("a",), ("\r",)], "t string")
    got = [r[0] for r in rows.select(strip_carriage_returns(F.col("t"))).collect()]
    assert got == ["a\rb", "a", ""]


def test_safe_rate(spark):
    rates = spark.range(1).select(
        safe_rate(F.lit(1), F.lit(4)).alias("a"), safe_rate(F.lit(1), F.lit(0)).alias("b")
    )
    assert tuple(rates.first()) == (0.25, None)
