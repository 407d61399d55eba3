"""The calendar and the warehouse parsers as SQL functions of a session.

``register(spark)`` creates temporary functions, so that plain SQL can say

    SELECT * FROM date_spine(DATE'2024-01-01', DATE'2024-12-31');
    SELECT p.* FROM wms_report r, LATERAL parse_wms_inventory(r.sku, r.item_description, ...) p WHERE r.customer IS NOT NULL;

A scalar function is one SQL expression and a parser one SELECT over its arguments, so Catalyst puts
their bodies in place: a parser called with LATERAL becomes a projection over the report, with no join and no Python.
They give what :mod:`opsmart.functions` and :mod:`opsmart.plans.feeds` give; ``tests/test_sql_functions.py`` holds them together.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from opsmart.functions.dates import US_TIMESTAMP
from opsmart.functions.sku import DELETED_SKU, MARK
from opsmart.operators.series import HISTORY_START

#: name(arguments), type, expression
SCALARS = [
    ("sku_has_mark(raw STRING)", "BOOLEAN", f"contains(raw, '{MARK}')"),
    ("sku_tail(raw STRING)", "STRING", f"CASE WHEN sku_has_mark(raw) THEN split_part(raw, '{MARK}', 2) END"),
    (
        "clean_sku_current(raw STRING)",
        "STRING",
        f"""CASE WHEN sku_has_mark(raw) THEN replace(split_part(split_part(raw, '{MARK}', 1), '/', 1), ' ', '')
            WHEN startswith(raw, '.') THEN replace(substr(raw, 2), '{DELETED_SKU}', '')
            WHEN endswith(raw, '{DELETED_SKU}') THEN replace(raw, '{DELETED_SKU}', '')
            ELSE raw END""",
    ),
    ("clean_sku_line(raw STRING)", "STRING", f"trim(regexp_replace(raw, '{DELETED_SKU}|[.]', ''))"),
    ("sku_upc(raw STRING)", "STRING", "split_part(sku_tail(raw), '/', 2)"),
    ("sku_location(raw STRING)", "STRING", "split_part(sku_tail(raw), '/', 1)"),
    ("is_misc_supply(raw STRING)", "BOOLEAN", "coalesce(startswith(raw, 'MISC SUPPLY'), false)"),
    ("parse_amount(shown STRING)", "DOUBLE", "try_cast(regexp_replace(shown, '[$,]', '') AS DOUBLE)"),
    ("parse_count(shown STRING)", "BIGINT", "CAST(round(parse_amount(shown)) AS BIGINT)"),
    ("parse_us_timestamp(shown STRING)", "TIMESTAMP", f"try_to_timestamp(shown, '{US_TIMESTAMP}')"),
    (
        "parse_slash_date(shown STRING)",
        "DATE",
        """CASE WHEN trim(shown) RLIKE '^[0-9]{1,2}/[0-9]{1,2}/([0-9]{2}|[0-9]{4})$' THEN try_cast(concat(
            CASE WHEN length(split_part(trim(shown), '/', 3)) = 2 THEN '20' ELSE '' END, split_part(trim(shown), '/', 3), '-',
            lpad(split_part(trim(shown), '/', 1), 2, '0'), '-', lpad(split_part(trim(shown), '/', 2), 2, '0')) AS DATE) END""",
    ),
    ("is_month_end(day DATE)", "BOOLEAN", "coalesce(day = last_day(day), false)"),
    ("file_line_id(file STRING, line BIGINT)", "STRING", "sha2(concat(file, '-', CAST(line AS STRING)), 256)"),
]

#: The 17 columns of the calendar: name, type, expression of ``date``.
CALENDAR = [
    ("date", "DATE", "date"),
    ("day_of_week", "INT", "dayofweek(date)"),
    ("day_of_week_text", "STRING", "upper(date_format(date, 'E'))"),
    ("is_weekday", "BOOLEAN", "dayofweek(date) NOT IN (1, 7)"),
    ("last_weekday_of_month", "DATE", "CASE WHEN date = last_day(date) AND dayofweek(date) NOT IN (1, 7) THEN date END"),
    ("week_first_day", "DATE", "CAST(date_trunc('week', date) AS DATE)"),
    ("week_last_day", "DATE", "date_add(CAST(date_trunc('week', date) AS DATE), 6)"),
    ("month_first_day", "DATE", "trunc(date, 'month')"),
    ("month_last_day", "DATE", "last_day(date)"),
    ("month_text", "STRING", "upper(date_format(date, 'MMMM'))"),
    ("quarter_first_day", "DATE", "trunc(date, 'quarter')"),
    ("quarter_last_day", "DATE", "date_sub(add_months(trunc(date, 'quarter'), 3), 1)"),
    ("year", "INT", "year(date)"),
    ("month_number", "INT", "month(date)"),
    ("quarter_number", "INT", "quarter(date)"),
    ("month_year", "STRING", "concat('M', month(date), ' ', year(date))"),
    ("quarter_year", "STRING", "concat('Q', quarter(date), ' ', year(date))"),
]
_CALENDAR_TYPE = ", ".join(f"{n} {t}" for n, t, _ in CALENDAR)
_CALENDAR_OF = ", ".join(f"{e} AS {n}" for n, _, e in CALENDAR)

#: The current-stock report: its columns, and what a row of it (``given``) becomes.
WMS_COLUMNS = (
    "sku STRING, item_description STRING, warehouse STRING, customer STRING, detail_on_hand STRING, textbox_39 STRING, "
    "detail_available STRING, detail_cartons STRING, detail_packed STRING, detail_cu_ft STRING, detail_weight STRING, end_date STRING, "
    "_file STRING, _line BIGINT"
)
WMS_ROW = [
    ("hdc_sku", "STRING", "given.sku"),
    ("sku", "STRING", "clean_sku_current(given.sku)"),
    ("upc", "STRING", "sku_upc(given.sku)"),
    ("misc_supply", "BOOLEAN", "is_misc_supply(given.sku)"),
    ("sku_name", "STRING", "given.item_description"),
    ("warehouse", "STRING", "given.warehouse"),
    ("warehouse_location", "STRING", "sku_location(given.sku)"),
    ("brand_name", "STRING", "given.customer"),
    ("on_hand", "BIGINT", "parse_count(given.detail_on_hand)"),
    ("on_hold", "BIGINT", "parse_count(given.textbox_39)"),
    ("available", "BIGINT", "parse_count(given.detail_available)"),
    ("dim_quantity", "DOUBLE", "parse_amount(given.detail_cartons)"),
    ("packed", "BIGINT", "parse_count(given.detail_packed)"),
    ("cu_ft", "DOUBLE", "parse_amount(given.detail_cu_ft)"),
    ("weight", "DOUBLE", "parse_amount(given.detail_weight)"),
    ("inv_run", "DATE", "CAST(parse_us_timestamp(given.end_date) AS DATE)"),
    ("month_end", "BOOLEAN", "is_month_end(CAST(parse_us_timestamp(given.end_date) AS DATE))"),
    ("month_end_date", "DATE", "last_day(CAST(parse_us_timestamp(given.end_date) AS DATE))"),
    ("_row_id", "STRING", "file_line_id(given._file, given._line)"),
]


def _table(name: str, arguments: str, columns: str, body: str) -> str:
    return f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS TABLE ({columns}) RETURN {body}"


def statements() -> list[str]:
    """The CREATE FUNCTION statements, each after those it calls."""
    days = f"SELECT {_CALENDAR_OF} FROM (SELECT explode(sequence({{0}}, {{1}}, INTERVAL 1 DAY)) AS date)"
    horizon = "make_date(year(as_of) + 2, 12, 31)"
    spans = [
        ("spine_to_today", f"DATE'{HISTORY_START}'", "as_of"),
        ("spine_projections", "as_of", horizon),
        ("spine_historical_and_projections", f"DATE'{HISTORY_START}'", horizon),
    ]
    # An argument goes by the function's name, lest a column of the result be taken for it.
    row = ", ".join(f"{e} AS {n}" for n, _, e in WMS_ROW).replace("given.", "parse_wms_inventory.")
    return [
        *[f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {kind} RETURN {body}" for head, kind, body in SCALARS],
        _table("date_spine", "first_day DATE, last_day DATE", _CALENDAR_TYPE, days.format("first_day", "date_spine.last_day")),
        *[_table(name, "as_of DATE", _CALENDAR_TYPE, days.format(low, high)) for name, low, high in spans],
        _table("parse_wms_inventory", WMS_COLUMNS, ", ".join(f"{n} {t}" for n, t, _ in WMS_ROW), f"SELECT {row}"),
    ]


def register(spark: SparkSession) -> None:
    """Create the functions in this session; those of the same names are replaced."""
    for statement in statements():
        spark.sql(statement)
