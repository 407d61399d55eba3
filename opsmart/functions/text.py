"""String predicates and small extractors."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def full_match(text: Column, pattern: str) -> Column:
    """Regex that must cover the whole string (Spark's ``rlike`` only searches)."""
    return text.rlike(f"^(?:{pattern})$")


def flag(predicate: Column) -> Column:
    """Two-valued flag: an unknown predicate counts as false."""
    return F.coalesce(predicate, F.lit(False))


def strip_leading_zeros(text: Column) -> Column:
    """PO numbers: drop leading zeros, but only when the text is all digits."""
    return F.when(full_match(text, "[0-9]+"), F.regexp_replace(text, "^0+", "")).otherwise(text)


def blank_to_null(text: Column, *sentinels: str) -> Column:
    """Empty text, and any given sentinel such as an all-zero UPC, -> NULL."""
    out = F.nullif(text, F.lit(""))
    for value in sentinels:
        out = F.nullif(out, F.lit(value))
    return out


def code_of(text: Column) -> Column:
    """``810-Invoice`` -> ``810``"""
    return F.substring(text, 1, 3)


def label_of(text: Column) -> Column:
    """``810-Invoice`` -> ``Invoice``"""
    return F.substr(text, F.lit(5))


def is_cancelled(ship_date_text: Column) -> Column:
    """Warehouse reports mark a cancelled order inside the ship-date text."""
    return flag(ship_date_text.like("%-CAN%") | ship_date_text.like("%- CAN%"))


def without_cancel_mark(ship_date_text: Column) -> Column:
    return F.replace(ship_date_text, F.lit("- CAN"), F.lit(""))


def resource_id(identifier: Column, resource: Column, marker: str) -> Column:
    """The id itself, or what follows ``marker`` in a resource path."""
    return F.coalesce(identifier.cast("string"), F.split_part(resource, F.lit(marker), F.lit(2)))


def any_ilike(text: Column, patterns: list[str]) -> Column:
    """True when the text matches any of the patterns, ignoring case."""
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | flag(text.ilike(pattern))
    return hit
