"""Rounding shared by every money expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round2(value: Column) -> Column:
    """Half-up rounding to cents; one definition so that batch, stream and SQL agree."""
    return F.floor(value * 100 + F.lit(0.5)) / F.lit(100.0)


def as_long(name: str) -> Column:
    """NULL instead of an error for text that is no whole number."""
    return F.col(name).try_cast("bigint")


def as_double(name: str) -> Column:
    return F.col(name).try_cast("double")
