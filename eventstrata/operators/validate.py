"""Bronze to typed rows with at most one reject reason each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventstrata import config as C
from eventstrata.config import DEFAULT, StreamConfig
from eventstrata.functions.text import blank_to_null
from eventstrata.functions.times import parse_utc
from eventstrata.sources.vocabulary import vocabulary

def quarantine_columns(config: StreamConfig = DEFAULT) -> tuple[str, ...]:
    fields = [f"{f}_raw" if f in C.TIMESTAMP_FIELDS else f for f in config.fields]
    return ("_source_row", "_source_file", "reject_reason", *fields, "_raw_payload")


QUARANTINE_COLUMNS = quarantine_columns()


def normalize(bronze: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    """Blank identifiers become NULL, timestamps are typed, their raw text is kept."""
    lineage = [c for c in bronze.columns if c not in config.fields]
    return bronze.select(
        *lineage,
        *[blank_to_null(F.col(c)).alias(c) for c in config.identifiers],
        *[F.col(c).alias(f"{c}_raw") for c in C.TIMESTAMP_FIELDS],
        *[parse_utc(F.col(c)).alias(c) for c in C.TIMESTAMP_FIELDS],
    )


def first_failure(rules: Sequence[tuple[str, Column]]) -> Column:
    """The code of the first rule that holds, else NULL."""
    code, failed = rules[0]
    chain = F.when(failed, F.lit(code))
    for code, failed in rules[1:]:
        chain = chain.when(failed, F.lit(code))
    return chain


def reject_rules() -> list[tuple[str, Column]]:
    return [
        (C.UNPARSEABLE_JSON, ~F.col("_is_valid_json")),
        (C.MISSING_EVENT_ID, F.col("event_id").isNull()),
        (C.MISSING_ORDER_ID, F.col("order_id").isNull()),
        (C.UNKNOWN_EVENT_TYPE, F.col("lifecycle_rank").isNull()),
        (C.INVALID_EVENT_TIME, F.col("event_time").isNull()),
        (C.INVALID_INGESTED_AT, F.col("ingested_at").isNull()),
    ]


def match_vocabulary(typed: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    """Left join to the vocabulary; a type that misses (or is NULL) has no rank."""
    known = vocabulary(typed.sparkSession, config).drop("is_terminal")
    return typed.join(F.broadcast(known), "event_type", "left")


def validate(bronze: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    typed = normalize(bronze, config)
    return (
        match_vocabulary(typed, config)
        .withColumn("reject_reason", first_failure(reject_rules()))
        .select(*typed.columns, F.md5("_raw_payload").alias("_payload_md5"), "reject_reason")
    )


def slim(validated: DataFrame) -> DataFrame:
    """What later stages need of each row: the digest of a valid one, the texts of a bad one."""
    bad = F.col("reject_reason").isNotNull()
    texts = ("event_time_raw", "ingested_at_raw", "_raw_payload")
    return validated.drop("_is_valid_json").withColumns(
        {
            "_payload_md5": F.when(~bad, F.col("_payload_md5")),
            **{c: F.when(bad, F.col(c)) for c in texts},
        }
    )


def rejected(validated: DataFrame, config: StreamConfig = DEFAULT) -> DataFrame:
    bad = validated.where(F.col("reject_reason").isNotNull())
    return bad.select(*quarantine_columns(config))


def valid(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("reject_reason").isNull())
