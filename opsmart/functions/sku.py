"""SKU, UPC and bin-location extraction from warehouse report strings.

A raw SKU may carry a ``-DELETE`` suffix, stray dots and blanks, or the form
``<sku> SKU#:<bin>/<upc>`` where a bin looks like ``A12-34``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Markers and shapes that occur in the warehouse reports.
MARK = "SKU#:"
DELETED_SKU = "-DELETE"
DELETED_ITEM = "DELETED"
BIN_ANYWHERE = "%___-__%"
BIN_PREFIX = "___-__%"
BIN_PREFIX_SPACED = "___-__ %"
HEADER = "Warehouse: "


def _has_mark(raw: Column) -> Column:
    return raw.contains(MARK)


def _before_mark(raw: Column) -> Column:
    return F.split_part(F.split_part(raw, F.lit(MARK), F.lit(1)), F.lit("/"), F.lit(1))


def _after_mark(raw: Column) -> Column:
    return F.split_part(raw, F.lit(MARK), F.lit(2))


def _segment(text: Column, n: int) -> Column:
    return F.split_part(text, F.lit("/"), F.lit(n))


def _no_blanks(text: Column) -> Column:
    return F.regexp_replace(text, r"\s", "")


def clean_sku_history(raw: Column) -> Column:
    """Snapshot reports: drop marks, dots and all white space; a SKU that would
    vanish that way is kept as it came."""
    squeezed = F.regexp_replace(raw, r"-DELETE|[.\s]", "")
    return (
        F.when(_has_mark(raw), F.regexp_replace(_before_mark(F.regexp_replace(raw, r"-DELETE|[.]", "")), r"\s", ""))
        .when(raw.startswith(".") | (squeezed != ""), squeezed)
        .otherwise(raw)
    )


def clean_sku_current(raw: Column) -> Column:
    """Current-stock reports: text before the mark, or a leading dot and the
    delete suffix taken off."""
    undeleted = F.replace(raw, F.lit(DELETED_SKU), F.lit(""))
    return (
        F.when(_has_mark(raw), F.replace(_before_mark(raw), F.lit(" "), F.lit("")))
        .when(raw.startswith("."), F.replace(F.substr(raw, F.lit(2)), F.lit(DELETED_SKU), F.lit("")))
        .when(raw.endswith(DELETED_SKU), undeleted)
        .otherwise(raw)
    )


def clean_sku_line(raw: Column) -> Column:
    """Order lines: delete suffix and dots off, trimmed."""
    return F.trim(F.regexp_replace(raw, r"-DELETE|[.]", ""))


def upc_history(raw: Column) -> Column:
    """Second ``/`` segment after the mark, else the whole text after it unless
    that is only a bin."""
    tail = _after_mark(raw)
    second = _no_blanks(_segment(tail, 2))
    whole = _no_blanks(tail)
    return F.when(_has_mark(raw) & (second != ""), second).when(
        _has_mark(raw) & ~whole.like(BIN_ANYWHERE), whole
    )


def upc_current(raw: Column) -> Column:
    return F.when(_has_mark(raw), _segment(_after_mark(raw), 2))


def location_history(raw: Column, qualifier: Column, description: Column) -> Column:
    """Qualifier, else the bin that opens the description, else the bin in the SKU."""
    item = F.replace(description, F.lit(DELETED_ITEM), F.lit(""))
    return (
        F.when(qualifier.isNotNull(), qualifier)
        .when(item.like(BIN_PREFIX_SPACED), F.substring(item, 1, 6))
        .when(_has_mark(raw) & raw.like(BIN_ANYWHERE), _segment(_after_mark(raw), 1))
    )


def location_current(raw: Column) -> Column:
    return F.when(_has_mark(raw), _segment(_after_mark(raw), 1))


def item_name(description: Column) -> Column:
    """Description without the delete mark and without its bin prefix; names
    that carry no bin are put in title case (words split on white space)."""
    item = F.replace(description, F.lit(DELETED_ITEM), F.lit(""))
    return F.when(item.like(BIN_PREFIX), F.regexp_replace(item, "^.{7}", "")).otherwise(F.initcap(item))


def warehouse_name(header: Column) -> Column:
    """``Warehouse: Reno From 3/1 ...`` -> ``Reno ``"""
    return F.split_part(F.replace(header, F.lit(HEADER), F.lit("")), F.lit("From"), F.lit(1))


def header_run_date(header: Column) -> Column:
    """The date in the first ten of the header's last 22 characters."""
    from opsmart.functions.dates import leading_date, parse_slash_date

    text = F.substring(F.right(header, F.lit(22)), 1, 10)
    return F.coalesce(leading_date(text), parse_slash_date(text))


def is_misc_supply(raw: Column) -> Column:
    return F.coalesce(raw.startswith("MISC SUPPLY"), F.lit(False))
