"""Ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_rate(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, NULL where there is nothing to measure."""
    return part.cast("double") / F.nullif(whole, F.lit(0))
