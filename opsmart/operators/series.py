"""Calendars, gap filling and running figures over daily or monthly grain.

Windows here run over data that is already aggregated to one row per key and
day (or month), so a partition never holds more rows than the calendar, however
hot the key was in the facts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from opsmart.functions.numbers import round_half_up

# Range of the standard calendar, and where its history starts.
SPINE_START, SPINE_END = "2019-01-01", "2030-12-31"
HISTORY_START = "2020-01-01"


def with_calendar(df: DataFrame, day: str = "date") -> DataFrame:
    """Add the 16 calendar attributes of ``day``.

    ``last_weekday_of_month`` is set only where the month's last day is itself a
    weekday: it stays NULL all month when the month ends on a weekend.
    """
    d = F.col(day)
    number = F.dayofweek(d)  # 1 = Sunday
    weekday = ~number.isin(1, 7)
    week = F.date_trunc("week", d).cast("date")
    quarter = F.trunc(d, "quarter")
    return df.withColumns(
        {
            "day_of_week": number,
            "day_of_week_text": F.upper(F.date_format(d, "E")),
            "is_weekday": weekday,
            "last_weekday_of_month": F.when((d == F.last_day(d)) & weekday, d),
            "week_first_day": week,
            "week_last_day": F.date_add(week, 6),
            "month_first_day": F.trunc(d, "month"),
            "month_last_day": F.last_day(d),
            "month_text": F.upper(F.date_format(d, "MMMM")),
            "quarter_first_day": quarter,
            "quarter_last_day": F.date_sub(F.add_months(quarter, 3), 1),
            "year": F.year(d),
            "month_number": F.month(d),
            "quarter_number": F.quarter(d),
            "month_year": F.concat(F.lit("M"), F.month(d).cast("string"), F.lit(" "), F.year(d).cast("string")),
            "quarter_year": F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.lit(" "), F.year(d).cast("string")),
        }
    )


def days_between(bounds: DataFrame, start: str, end: str, name: str = "date") -> DataFrame:
    """One row per day of each ``[start, end]`` in ``bounds``."""
    days = F.sequence(F.col(start).cast("date"), F.col(end).cast("date"), F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias(name))


def date_spine(spark: SparkSession, start: str | dt.date = SPINE_START, end: str | dt.date = SPINE_END) -> DataFrame:
    """The calendar table, 17 columns, one row per day."""
    bounds = spark.range(1).select(F.lit(str(start)).alias("a"), F.lit(str(end)).alias("b"))
    return with_calendar(days_between(bounds, "a", "b"))


def spine_over(df: DataFrame, day: str | Column) -> DataFrame:
    """The calendar from the first to the last ``day`` found in ``df``."""
    d = (F.col(day) if isinstance(day, str) else day).cast("date")
    return with_calendar(days_between(df.agg(F.min(d).alias("a"), F.max(d).alias("b")), "a", "b"))


def _as_date(as_of: str | dt.date | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")


def spine_window(spine: DataFrame, kind: str, as_of: str | dt.date | Column, since: str = HISTORY_START) -> DataFrame:
    """``to_today``, ``projections`` (today to the end of the year after next) or
    ``historical_and_projections``, seen from ``as_of``."""
    today = _as_date(as_of)
    horizon = F.make_date(F.year(today) + 2, F.lit(12), F.lit(31))
    history = F.lit(since).cast("date")
    d = F.col("date")
    tests = {
        "to_today": (d >= history) & (d <= today),
        "projections": (d >= today) & (d <= horizon),
        "historical_and_projections": (d >= history) & (d <= horizon),
    }
    return spine.filter(tests[kind])


def densify(entities: DataFrame, start: Column, end: Column, name: str = "date") -> DataFrame:
    """Every entity on every day of ``[start, end]``. Each row unfolds where it
    is: no join and no shuffle."""
    return entities.withColumn(name, F.explode(F.sequence(start, end, F.expr("interval 1 day"))))


def _window(keys: Sequence[str], order: Sequence[str]):
    return (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))).orderBy(*order)


def forward_fill(df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str]) -> DataFrame:
    """Carry the last known value of each column forward inside its key. One
    window, so one shuffle, for all columns."""
    w = _window(keys, [order]).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


def dealt(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` by ``keys``, before its rows unfold into many. Said here, since Spark would otherwise leave them by a part of the keys
    to save moving them, and then move the unfolded rows in joins by all keys. Adaptive execution keeps the number of partitions; by the
    size of these rows it would unfold a whole table in one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def fill_calendar(
    df: DataFrame, keys: Sequence[str], day: str, carried: Sequence[str], start: Column, end: Column,
    only_on_day: Sequence[str] = (), name: str = "date",
) -> DataFrame:
    """One row per key and day of ``[start, end]``, with ``carried`` columns holding
    the last value known by then and ``only_on_day`` columns set only on days that
    have a row. A key and day that ``df`` holds several times are there as often; the last of them is carried on.

    The same table as densify + left join + forward fill, but only the given
    rows are shuffled: each one learns its successor's day from a window and
    unfolds over the gap after that. A key without any row inside the range
    still gets its (empty) days; rows outside the range are not carried in.
    """
    inside = F.coalesce(F.col(day).between(start, end), F.lit(False))
    order = Window.partitionBy(*keys).orderBy(F.desc("_in"), day)
    past = order.rowsBetween(Window.unboundedPreceding, 0)
    marked = df.withColumn("_in", inside).withColumns(
        {
            "_rank": F.row_number().over(order),
            "_next": F.lead(F.when(F.col("_in"), F.col(day))).over(order),
            **{f"_c_{c}": F.last(F.when(F.col("_in"), F.col(c)), ignorenulls=True).over(past) for c in carried},
        }
    )
    marked = marked.filter(F.col("_in") | (F.col("_rank") == 1))
    first = F.when(F.col("_rank") == 1, start).otherwise(F.col(day))
    last = F.coalesce(F.date_sub("_next", 1), end)
    last = F.when(F.col("_in"), F.greatest(last, F.col(day))).otherwise(last)
    days = marked.withColumn(name, F.explode(F.sequence(first, last, F.expr("interval 1 day"))))
    here = F.col("_in") & (F.col(name) == F.col(day))
    since = F.col("_in") & (F.col(name) >= F.col(day))
    days = days.withColumns(
        {
            **{c: F.when(since, F.col(f"_c_{c}")) for c in carried},
            **{c: F.when(here, F.col(c)) for c in only_on_day},
        }
    )
    return days.drop("_in", "_rank", "_next", *[f"_c_{c}" for c in carried], *([day] if day != name else []))


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: dict[str, str | Column]) -> DataFrame:
    """Running totals ``{new column: value}``; ``df`` holds one row per key and
    order value, so counting rows and counting peers are the same thing."""
    w = _window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({n: F.sum(v).over(w) for n, v in sums.items()})


def running_by_day(facts: DataFrame, keys: Sequence[str], day: str, sums: dict[str, Column]) -> DataFrame:
    """Running totals up to and including each day, for facts of any grain.

    The default SQL frame counts all rows of the current day. Summing per day
    first gives exactly that, and keeps a hot key from being sorted in one task.
    Returns one row per key and day.
    """
    daily = facts.groupBy(*keys, day).agg(*[F.sum(v).alias(n) for n, v in sums.items()])
    return running_sums(daily, keys, [day], {n: n for n in sums})


def rolling_ratios(df: DataFrame, keys: Sequence[str], order: str, rows: int, values: dict[str, Column],
                   ratios: dict[str, tuple[str, str, int]]) -> DataFrame:
    """Ratios of sums over the last ``rows`` rows: ``{name: (top, bottom, digits)}``
    over the named ``values``. Rows, not days: missing days are not filled in.

    A sliding sum is the running sum less the running sum ``rows`` rows ago, so
    the cost per row does not grow with ``rows``. Give values as integers or
    decimals, for which that is exact.
    """
    by = _window(keys, [order])
    past = by.rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumns({f"_v_{n}": v for n, v in values.items()})
    out = out.withColumns(
        {
            **{f"_s_{n}": F.coalesce(F.sum(f"_v_{n}").over(past), F.lit(0)) for n in values},
            **{f"_n_{n}": F.count(f"_v_{n}").over(past) for n in values},
        }
    )

    def sliding(c: str) -> Column:
        return F.col(c) - F.coalesce(F.lag(c, rows).over(by), F.lit(0))

    # a sum over no value at all is NULL
    out = out.withColumns(
        {f"_r_{n}": F.when(sliding(f"_n_{n}") > 0, sliding(f"_s_{n}")).cast("double") for n in values}
    )
    out = out.withColumns(
        {
            name: round_half_up(F.try_divide(F.col(f"_r_{top}"), F.col(f"_r_{bottom}")), digits)
            for name, (top, bottom, digits) in ratios.items()
        }
    )
    return out.drop(*[f"_{kind}_{n}" for kind in "vsnr" for n in values])


def weighted_age(df: DataFrame, order: Sequence[str], value: str, name: str, cumulative: str) -> DataFrame:
    """``sum over b <= a of value_b * (a - b + 1)`` for each row ``a``.

    That triangular self join equals the running sum of the running sum, which
    takes two linear passes. ``df`` is a monthly aggregate.
    """
    out = running_sums(df, [], order, {cumulative: value})
    return running_sums(out, [], order, {name: cumulative})
