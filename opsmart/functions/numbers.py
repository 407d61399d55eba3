"""Numbers out of report text, guarded ratios, exact money."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(24,6)"


def parse_amount(text: Column) -> Column:
    """``$1,234.50`` -> 1234.5; anything that is not a number -> NULL."""
    return F.regexp_replace(text, "[$,]", "").try_cast("double")


def parse_count(text: Column) -> Column:
    """A quantity that lands in an integer column: parsed, rounded, bigint."""
    return F.round(parse_amount(text)).cast("bigint")


def parse_int(text: Column) -> Column:
    """``try_to_number``: decimal text is rounded half up, junk -> NULL."""
    return F.round(text.try_cast("decimal(38,6)")).try_cast("bigint")


def parse_wide_integer(text: Column) -> Column:
    """Tracking numbers: up to 38 digits, junk -> NULL."""
    return text.try_cast("decimal(38,0)")


def money(value: Column) -> Column:
    """Exact decimal, so sums do not depend on row order."""
    return value.cast(MONEY)


def round_half_up(value: Column, digits: int) -> Column:
    """Round a double on its decimal value, so that a quotient a hair below a
    tie still rounds up."""
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def ratio(top: Column, bottom: Column, digits: int | None = None, per: float | None = None) -> Column:
    """``top / bottom`` as double, NULL for a zero or missing divisor."""
    out = F.try_divide(top.cast("double"), bottom.cast("double"))
    if per is not None:
        out = out * F.lit(float(per))
    return out if digits is None else round_half_up(out, digits)


def from_micros(value: Column) -> Column:
    """Ad platforms bill in millionths of a currency unit."""
    return value / F.lit(1000000.0)
