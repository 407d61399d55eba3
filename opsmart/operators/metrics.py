"""Conditional aggregates and event pivots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def sum_if(condition: Column, value: Column) -> Column:
    """``sum(case when condition then value else 0 end)``"""
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def count_if(condition: Column) -> Column:
    """Number of rows that meet the condition; NULL only for no rows at all."""
    return sum_if(condition, F.lit(1))


def event_columns(events: DataFrame, wanted: dict[str, tuple[str, str]], day: str = "date",
                  name: str = "event_name") -> DataFrame:
    """One row per day with ``{output: (event name, value column)}``.

    One pass over the events instead of one join per event. Days lacking an
    event hold NULL. Rows of the same event and day are added up.
    """
    events = events.filter(F.col(name).isin(sorted({e for e, _ in wanted.values()})))
    return events.groupBy(day).agg(
        *[F.sum(F.when(F.col(name) == e, F.col(v))).alias(out) for out, (e, v) in wanted.items()]
    )


def presence_matrix(df: DataFrame, keys: list[str], column: str, values: dict[str, str]) -> DataFrame:
    """Boolean pivot ``{output: value}``: true where the value occurs, else NULL."""
    return df.groupBy(*keys).agg(
        *[F.max(F.when(F.col(column) == v, F.lit(True))).alias(out) for out, v in values.items()]
    )
