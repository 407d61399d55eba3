"""Dates out of report text and calendar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Day zero of spreadsheet serial dates; report time-stamp layout.
SERIAL_EPOCH = "1899-12-30"
US_TIMESTAMP = "M/d/yyyy h:mm:ss a"

_SHORT_YEAR = r"^\d{1,2}/\d{1,2}/\d{2}$"
_LONG_YEAR = r"^\d{1,2}/\d{1,2}/\d{4}$"


_ISO = r"^\d{4}-\d{2}-\d{2}$"


def _iso_date(text: Column) -> Column:
    """ISO text -> date without a pattern formatter, which is many times slower."""
    return F.when(text.rlike(_ISO), text.try_cast("date"))


def parse_slash_date(text: Column) -> Column:
    """``1/2/23`` and ``01/02/2023`` -> date (two-digit years are 20yy);
    anything else -> NULL."""
    trimmed = F.trim(text)
    month, day, year = (F.split_part(trimmed, F.lit("/"), F.lit(i)) for i in (1, 2, 3))
    rest = [F.lit("-"), F.lpad(month, 2, "0"), F.lit("-"), F.lpad(day, 2, "0")]
    return F.when(trimmed.rlike(_SHORT_YEAR), F.concat(F.lit("20"), year, *rest).try_cast("date")).when(
        trimmed.rlike(_LONG_YEAR), F.concat(year, *rest).try_cast("date")
    )


def parse_us_timestamp(text: Column) -> Column:
    """``03/31/2023 11:59:00 PM`` -> timestamp, junk -> NULL."""
    return F.try_to_timestamp(text, F.lit(US_TIMESTAMP))


def leading_date(text: Column) -> Column:
    """The ISO date in the first ten characters, junk -> NULL."""
    return _iso_date(F.substring(text.cast("string"), 1, 10))


def serial_date(days: Column) -> Column:
    """Spreadsheet day number -> date (45000 is 2023-03-15)."""
    return F.date_add(F.lit(SERIAL_EPOCH).cast("date"), days.cast("int"))


def report_date(file: Column, prefix: str) -> Column:
    """Date of a drop named ``<prefix>yyyy-MM-dd...``."""
    return leading_date(F.replace(file, F.lit(prefix), F.lit("")))


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def is_month_end(day: Column) -> Column:
    """True only on the last day of a month; a missing date is not one."""
    return F.coalesce(day == F.last_day(day), F.lit(False))


def with_period(df, day: str):
    """Append ``period_first_day`` and ``period_last_day`` of ``day``'s month."""
    return df.withColumns(
        {"period_first_day": month_start(F.col(day)), "period_last_day": F.last_day(F.col(day))}
    )
