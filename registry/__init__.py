"""Queries over the test tables, each next to its SQL counterpart.

The test tables are TPC-H-like, so each business source (shop orders, a
warehouse report, purchase orders, ...) is a *view* of them, written once in SQL
that both engines read (:mod:`registry.views`). The queries then run the
library on those views, and the counterpart SQL computes the same result by
other means.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from opsmart.session import materialise, tune_scans
from registry.views import VIEWS

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


_STORED: dict[tuple[str, str, str], DataFrame] = {}


def _names(sql: str) -> list[str]:
    return list(dict.fromkeys(f for _, f, _, _ in Formatter().parse(sql) if f))


class Sources:
    """``s.orders`` is a table, ``s.shop_orders`` a view; both are lazy."""

    def __init__(self, spark: SparkSession, folder: str):
        tune_scans(spark)
        self.spark, self.folder = spark, folder
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            if name in TABLES:
                self._made[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            else:
                self._made[name] = self.sql(VIEWS[name])
        return self._made[name]

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table derived from this folder that several queries read, such as a map of names: computed once a session and written."""
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _STORED:
            _STORED[key] = materialise(build(), name)
        return _STORED[key]

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text, **{n: getattr(self, n) for n in _names(text)})


def standalone_sql(text: str) -> str:
    """Counterpart SQL with the views it uses spelled out as CTEs."""
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for n in _names(sql):
            if n in VIEWS and n not in ordered:
                visit(VIEWS[n])
                ordered.append(n)

    def plain(sql: str) -> str:
        return sql.format(**{n: n for n in _names(sql)})

    visit(text)
    body = plain(text)
    ctes = ",\n".join(f"{n} AS ({plain(VIEWS[n])})" for n in ordered)
    if not ctes:
        return body
    stripped = body.lstrip()
    if stripped[:4].lower() == "with":
        rest = stripped[4:].lstrip()
        if rest[:9].lower() == "recursive":
            return f"WITH RECURSIVE {ctes},\n{rest[9:]}"
        return f"WITH {ctes},\n{rest}"
    return f"WITH {ctes}\n{body}"


@dataclass(frozen=True)
class Query:
    build: Callable[[Sources], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(key: str, sql: str | None = None):
    """Register ``build(sources) -> DataFrame`` with its counterpart SQL."""

    def add(build: Callable[[Sources], DataFrame]):
        if key in REGISTRY:
            raise ValueError(f"{key} is registered twice")
        REGISTRY[key] = Query(build, sql)
        return build

    return add


def load_all() -> dict[str, Query]:
    from registry import finance, inventory, load, match, purchasing, shop, sqlapi, text  # noqa: F401
    from registry import refresh  # noqa: F401  counts the rows of other queries

    return REGISTRY
