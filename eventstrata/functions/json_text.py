"""JSON validity and text extraction without inference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _exactly_one(parsed: Column) -> Column:
    return F.coalesce(F.size(parsed) == 1, F.lit(False))


def with_json_fields(
    df: DataFrame, payload: str, fields: Sequence[str], flag: str = "_is_valid_json"
) -> DataFrame:
    """Add a validity flag and one text column per top-level field.

    Spark's parsers stop at the end of the first value, so junk behind it goes unseen.
    Inside ``[...]`` a value must be followed by the closing bracket, which only a text with
    a bracket of its own can fake; such a text is parsed inside ``{"w":...}`` as well, where
    that bracket is an error. The bracketed parse is strict and keeps every field as text,
    so one pass serves both the check and all the columns; a lookup in the parsed map finds
    the first of repeated keys. Valid JSON that is no object takes a second bracketed parse
    and has no fields.
    """
    text = F.col(payload)
    boxed = F.concat(F.lit("["), text, F.lit("]"))
    held = F.concat(F.lit('{"w":'), text, F.lit("}"))
    parsed = df.select(
        "*",
        F.from_json(boxed, "array<map<string,string>>", STRICT).alias("_objects"),
        (~text.contains("]") | F.json_object_keys(held).isNotNull()).alias("_closed"),
    )
    no_object = F.col("_objects").isNull() & _exactly_one(
        F.from_json(boxed, "array<string>", STRICT)
    )
    flagged = parsed.select(
        *df.columns,
        "_objects",
        (F.col("_closed") & (_exactly_one(F.col("_objects")) | no_object)).alias(flag),
    )
    first = F.col("_objects")[0]
    return flagged.select(
        *df.columns, flag, *[F.when(F.col(flag), first[name]).alias(name) for name in fields]
    )
