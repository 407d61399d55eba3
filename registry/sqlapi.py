"""The SQL functions of the library, called by ``spark.sql`` alone."""

from __future__ import annotations

from opsmart.functions import sql
from registry import query
from registry.inventory import WMS_SQL, _STOCK
from registry.sqltext import CALENDAR, SPINE

_DAILY = "select cast(o_orderdate as date) as date, count(*) as n_orders from {orders} group by 1"


def _run(s, text: str):
    sql.register(s.spark)
    return s.sql(text)


@query("sql_date_spine", f"with {SPINE}, daily as ({_DAILY}) select date, {CALENDAR}, n_orders from spine left join daily using (date)")
def _(s):
    return _run(
        s,
        f"""with daily as ({_DAILY}), days as (select min(date) as a, max(date) as b from daily)
        select d.*, n_orders from days, lateral date_spine(days.a, days.b) d left join daily on daily.date = d.date""",
    )


_SPANS = ["to_today", "projections", "historical_and_projections"]
_AS_OF = "2021-03-15"
_WINDOWS = {
    "to_today": f"date '2020-01-01' and date '{_AS_OF}'",
    "projections": f"date '{_AS_OF}' and date '2023-12-31'",
    "historical_and_projections": "date '2020-01-01' and date '2023-12-31'",
}


@query(
    "sql_spine_windows",
    "with orders_shifted as (select cast(o_orderdate as date) + 7305 as day from {orders}), "
    "days as (select cast(unnest(generate_series(date '2020-01-01', date '2023-12-31', interval 1 day)) as date) as date) "
    + " union all ".join(
        f"""select '{k}' as kind, date, month_text, n_orders from (select date, upper(strftime(date, '%B')) as month_text, count(day) as n_orders
        from days left join orders_shifted on day = date where date between {w} group by 1)"""
        for k, w in _WINDOWS.items()
    ),
)
def _(s):
    """Orders, moved on by twenty years into the calendar, counted by day and shown over its three windows."""
    return _run(
        s,
        "with shifted_days as (select date_add(cast(o_orderdate as date), 7305) as day, count(*) as n from {orders} group by 1) "
        + " union all ".join(
            f"""select '{k}' as kind, date, month_text, coalesce(n, 0) as n_orders
            from spine_{k}(date'{_AS_OF}') left join shifted_days on day = date"""
            for k in _SPANS
        ),
    )


@query("sql_wms_inventory", WMS_SQL)
def _(s):
    arguments = ", ".join(f"r.{c.split()[0]}" for c in sql.WMS_COLUMNS.split(", "))
    return _run(
        s,
        f"""select {', '.join('p.' + c for c in _STOCK)} from {{wms_report}} r, lateral parse_wms_inventory({arguments}) p
        where r.customer is not null""",
    )
