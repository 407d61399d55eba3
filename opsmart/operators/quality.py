"""Data-quality and freshness checks. Each returns a small DataFrame."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Hours after which a source counts as late.
WARN_HOURS, ERROR_HOURS = 48, 72


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their counts (NULL is no value)."""
    return (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
    )


def unique_check(df: DataFrame, column: str) -> DataFrame:
    return duplicates(df, column).agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(f"unique({column})").alias("check"), "failures", (F.col("failures") == 0).alias("passed")
    )


def not_null_check(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_if(F.col(column).isNull()).alias("failures")).select(
        F.lit(f"not_null({column})").alias("check"), "failures", (F.col("failures") == 0).alias("passed")
    )


def freshness(df: DataFrame, synced: str, as_of: str | dt.datetime | Column, warn: int = WARN_HOURS,
              error: int = ERROR_HOURS) -> DataFrame:
    """Newest sync, its age in hours and ``pass`` / ``warn`` / ``error``. A table
    without any sync time is an error."""
    now = as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("timestamp")
    newest = df.agg(F.max(F.col(synced).cast("timestamp")).alias("newest"))
    age = (F.unix_micros(now) - F.unix_micros("newest")) / F.lit(3_600_000_000.0)
    status = (
        F.when(age.isNull() | (age > error), "error").when(age > warn, "warn").otherwise("pass")
    )
    return newest.select("newest", age.alias("age_hours"), status.alias("status"))


@dataclass(frozen=True)
class Watch:
    """Checks that a load takes while it writes its rows: columns that must not be NULL, and the sync time.

    Each figure of a table follows from those of its batches (sums and a maximum), so a table is never scanned for them.
    """

    not_null: tuple[str, ...] = ()
    synced: str | None = None

    def figures(self) -> list[Column]:
        """Aggregates over the rows of a batch; the newest sync time as UTC microseconds."""
        nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null:{c}") for c in self.not_null]
        return nulls + ([F.max(F.unix_micros(F.col(f"`{self.synced}`").cast("timestamp"))).alias("newest")] if self.synced else [])

    def added(self, figures: dict, batch: dict) -> dict:
        """Figures of a table after one more batch; an empty one changes nothing."""
        out = {f"null:{c}": (figures.get(f"null:{c}") or 0) + (batch.get(f"null:{c}") or 0) for c in self.not_null}
        if self.synced:
            out["newest"] = max((f["newest"] for f in (figures, batch) if f.get("newest") is not None), default=None)
        return out

    def report(self, spark: SparkSession, figures: dict, key: str = "") -> DataFrame:
        """One row a check, as :func:`not_null_check` and :func:`unique_check` give them. ``key`` is unique because loads see to it."""
        found = {f"not_null({c})": figures[f"null:{c}"] for c in self.not_null} | ({f"unique({key})": 0} if key else {})
        rows = [(name, n, n == 0) for name, n in found.items()]
        return spark.createDataFrame(rows, "check string, failures bigint, passed boolean")

    def synced_table(self, spark: SparkSession, figures: dict) -> DataFrame:
        """The newest sync as a table of one row, for :func:`freshness`."""
        return spark.createDataFrame([(figures.get("newest"),)], "newest bigint").select(F.timestamp_micros("newest").alias(self.synced))


def last_updated(tables: dict[tuple[str, str], tuple[DataFrame, str]]) -> DataFrame:
    """Newest change per ``(schema, table)``: ``{key: (table, time column)}``."""
    rows = [
        df.agg(F.max(F.col(c).cast("timestamp")).alias("last_updated")).select(
            F.lit(schema).alias("schema_name"), F.lit(table).alias("table_name"), "last_updated"
        )
        for (schema, table), (df, c) in tables.items()
    ]
    union = reduce(lambda a, b: a.unionByName(b), rows)
    return union.groupBy("schema_name", "table_name").agg(F.max("last_updated").alias("last_updated"))


def as_object_array(updates: DataFrame) -> DataFrame:
    """The last-updated list as one row holding an array of objects. One entry
    per table of the catalogue, so the array stays small."""
    return updates.agg(
        F.sort_array(F.collect_list(F.struct("schema_name", "table_name", "last_updated"))).alias("updates")
    )


def flatten_objects(df: DataFrame, column: str, fields: dict[str, str]) -> DataFrame:
    """Unfold an array of objects (or a VARIANT array) into typed columns
    ``{field: type}``."""
    if df.schema[column].dataType.typeName() == "variant":
        exploded = df.lateralJoin(
            df.sparkSession.tvf.variant_explode(F.col(column).outer())
        )
        return exploded.select(
            *[F.try_variant_get("value", f"$.{f}", t).alias(f) for f, t in fields.items()]
        )
    return df.select(F.explode(column).alias("_e")).select(
        *[F.col(f"_e.{f}").cast(t).alias(f) for f, t in fields.items()]
    )
