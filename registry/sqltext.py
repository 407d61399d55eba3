"""Pieces of counterpart SQL (DuckDB dialect)."""


def div(top: str, bottom: str) -> str:
    return f"(cast({top} as double) / nullif(cast({bottom} as double), 0))"


def rnd(value: str, digits: int) -> str:
    """Half-up rounding on decimals, as Spark rounds doubles."""
    return f"cast(round(cast({value} as decimal(28,10)), {digits}) as double)"


#: Calendar days from the first to the last order.
SPINE = """spine as (
    select cast(d as date) as date from (
        select unnest(generate_series((select min(cast(o_orderdate as date)) from orders),
                                      (select max(cast(o_orderdate as date)) from orders), interval 1 day)) as d))"""

CALENDAR = """
    cast(dayofweek(date) + 1 as integer) as day_of_week,
    upper(strftime(date, '%a')) as day_of_week_text,
    dayofweek(date) not in (0, 6) as is_weekday,
    case when month(date + 1) <> month(date) and dayofweek(date) not in (0, 6) then date end as last_weekday_of_month,
    cast(date_trunc('week', date) as date) as week_first_day,
    cast(date_trunc('week', date) as date) + 6 as week_last_day,
    cast(date_trunc('month', date) as date) as month_first_day,
    cast(date_trunc('month', date) + interval 1 month as date) - 1 as month_last_day,
    upper(strftime(date, '%B')) as month_text,
    cast(date_trunc('quarter', date) as date) as quarter_first_day,
    cast(date_trunc('quarter', date) + interval 3 month as date) - 1 as quarter_last_day,
    cast(year(date) as integer) as year,
    cast(month(date) as integer) as month_number,
    cast(quarter(date) as integer) as quarter_number,
    'M' || month(date) || ' ' || year(date) as month_year,
    'Q' || quarter(date) || ' ' || year(date) as quarter_year"""

#: Valid shop orders, as the funnel counts them.
VALID = "is_confirmed and not is_test_order and not is_deleted and source_name <> 'marketplace'"
