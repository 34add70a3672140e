"""Column builders for text with Unicode-aware white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def collapsed(x: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def stripped(x: Column) -> Column:
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def folded(x: Column) -> Column:
    """For comparison: lower case, collapsed; null reads as empty."""
    return collapsed(F.lower(F.coalesce(x, F.lit(""))))


def given(x: Column) -> Column:
    """The stripped value, null if nothing is left."""
    return F.nullif(stripped(x), F.lit(""))


def captured(x: Column, pattern: str, group: int = 1) -> Column:
    """A regex group, stripped; null without a match."""
    return given(F.regexp_extract(x, pattern, group))


def first_captured(x: Column, *patterns: str) -> Column:
    return F.coalesce(*[captured(x, p) for p in patterns])


def literal_map(entries: dict) -> Column:
    return F.create_map(*[F.lit(v) for kv in entries.items() for v in kv])


def strict_date(x: Column) -> Column:
    """A date written exactly as YYYY-MM-DD; null otherwise."""
    return F.when(x.rlike(r"^\d{4}-\d{2}-\d{2}$"), x.try_cast("date"))
