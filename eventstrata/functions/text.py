"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode space separators: a tab or a newline is content, a no-break space is padding.
SPACES = "".join(
    chr(c) for c in (0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)
)


def strip_spaces(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def strip_carriage_returns(text: Column) -> Column:
    """From both ends. Lines without any, the usual case, pass untouched."""
    cr = F.lit("\r")
    return F.when(text.startswith(cr) | text.endswith(cr), F.btrim(text, cr)).otherwise(text)


def blank_to_null(text: Column) -> Column:
    return F.nullif(strip_spaces(text), F.lit(""))


def is_blank(text: Column) -> Column:
    """Nothing but space separators. JSON objects are told by their first byte."""
    return ~(text.startswith("{") | text.rlike(r"[^\p{Zs}]"))
