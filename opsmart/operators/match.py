"""Matching by exact keys.

No join here carries a broadcast hint: Spark broadcasts a side when its size,
measured from statistics or at run time, is below
``spark.sql.autoBroadcastJoinThreshold``, and otherwise shuffles and splits the
partitions of hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _pack(dim: DataFrame, key: str, cols: Sequence[str], tag: str) -> DataFrame:
    """``dim`` reduced to its key and one struct, so that a found record with
    NULL attributes still counts as found."""
    return dim.filter(F.col(key).isNotNull()).select(
        F.col(key).alias(f"_k{tag}"), F.struct(*[F.col(c) for c in dict.fromkeys([key, *cols])]).alias(f"_r{tag}")
    )


def enrich(df: DataFrame, dim: DataFrame, on: str, key: str, cols: dict[str, str]) -> DataFrame:
    """Left join of a dimension; ``cols`` maps its columns to output names."""
    picked = dim.select(F.col(key).alias("_k"), *[F.col(c).alias(n) for c, n in cols.items()])
    return df.join(picked, df[on] == picked["_k"], "left").drop("_k")


def enrich_roles(df: DataFrame, dim: DataFrame, key: str, roles: dict[str, dict[str, str]]) -> DataFrame:
    """The same dimension in several roles: ``{fact column: {dim column: output}}``."""
    for on, cols in roles.items():
        df = enrich(df, dim, on, key, cols)
    return df


def lookup_chain(df: DataFrame, dim: DataFrame, chain: Sequence[tuple[str, str]], cols: dict[str, str]) -> DataFrame:
    """Try the ``(fact column, dim key)`` pairs in order; each output column is
    the first value found along the chain."""
    wanted = list(cols)
    out = df
    for i, (on, key) in enumerate(chain):
        packed = _pack(dim, key, wanted, str(i))
        out = out.join(packed, F.col(on) == F.col(f"_k{i}"), "left")
    found = {
        name: F.coalesce(*[F.col(f"_r{i}.{c}") for i in range(len(chain))]) for c, name in cols.items()
    }
    return out.select(*[F.col(c) for c in df.columns], *[v.alias(n) for n, v in found.items()])


def match_audit(
    df: DataFrame, dim: DataFrame, cols: Sequence[str], by_sku: tuple[str, str] = ("sku", "sku"),
    by_upc: tuple[str, str] = ("upc", "upc"), name: str = "sku_name", matched_name: str = "ref_sku_name",
) -> DataFrame:
    """Which distinct items are found in the dimension by SKU, and which by UPC.

    Distinct comes before the joins, so they run over items and not over facts.
    """
    items = df.select(*cols).distinct()
    sku_side = _pack(dim, by_sku[1], [name], "s")
    upc_side = _pack(dim, by_upc[1], [], "u").select("_ku").distinct()
    return (
        items.join(sku_side, F.col(by_sku[0]) == F.col("_ks"), "left")
        .join(upc_side, F.col(by_upc[0]) == F.col("_ku"), "left")
        .select(
            *cols,
            F.col("_ks").isNotNull().alias("sku_matched"),
            F.col(f"_rs.{name}").alias(matched_name),
            F.col("_ku").isNotNull().alias("upc_matched"),
        )
        .distinct()
    )


def remap_key(df: DataFrame, mapping: DataFrame, column: str, alias: str, target: str) -> DataFrame:
    """Replace a local alias by its reference key where the mapping has one."""
    m = mapping.select(F.col(alias).alias("_alias"), F.col(target).alias("_target"))
    return (
        df.join(m, df[column] == m["_alias"], "left")
        .withColumn(column, F.coalesce("_target", F.col(column)))
        .drop("_alias", "_target")
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int = 1,
                  rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of each key. Catalyst prunes to ``n`` rows per key
    and map task before the shuffle, so a hot key never travels whole."""
    name = rank or "_rank"
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
    return out if rank else out.drop(name)


def current_records(history: DataFrame, flag: str = "is_most_recent_record") -> DataFrame:
    """Current rows of a history dimension; the filter reaches the scan."""
    return history.filter(F.col(flag))


def share_matched(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Coverage report: rows, and matched rows and percentage per flag."""
    total = F.count(F.lit(1))
    aggs = [total.alias("total_rows")]
    for f in flags:
        hits = F.count_if(F.col(f))
        aggs += [hits.alias(f"{f}_rows"), (F.try_divide(hits, total) * 100).alias(f"{f}_pct")]
    return df.agg(*aggs)

