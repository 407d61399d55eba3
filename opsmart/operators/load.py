"""Incremental loads over immutable tables.

Parquet has no UPDATE, so every load is a pure function ``(batch, target) ->
next target``. :class:`opsmart.sources.store.TableStore` keeps tables by the
same rules but appends only. The anti join on the row id is the only wide step:
ids are SHA-256 text, so it spreads evenly whatever the business keys look like.
Daily tables, which have an id for each key and day, use :func:`new_days` instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: What happens to the ``latest`` flag of old and new rows.
POLICIES = (
    "flip_all",        # old rows lose the flag, the batch gets it, whatever is new
    "flip_if_new",     # the same, but only if the batch holds an unseen row
    "flip_true_only",  # as flip_if_new: touching only true rows ends in the same table
    "flip_matched",    # only re-delivered rows lose it; rows absent from the batch keep it
    "max_of_batch",    # flag = newest value of ``order`` over target and batch
    "max_sync_minute", # flag = synced in the newest minute of the batch
    "keep",            # append only, no flag kept
)
#: Groups of rows whose digests are compared. A comparison broadcasts their numbers, so no more rows than this.
GROUPS = 4096


@dataclass(frozen=True)
class LoadStats:
    new: int
    before: int
    after: int


def new_rows(batch: DataFrame, target: DataFrame, key: str = "_row_id") -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target`` (a NULL key is never in it).

    The target is narrowed to the keys of the batch first. A small batch is
    broadcast for that, so a huge target is scanned but never shuffled; a large
    one shuffles both on the evenly spread row id.
    """
    seen = target.select(key).join(batch.select(key), key, "left_semi")
    return batch.join(seen, key, "left_anti")


def new_days(batch: DataFrame, target: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """:func:`new_rows` for daily tables whose row id is made of ``keys`` and the date ``day``; a row in which one of them is NULL is new.

    Ids are 64 digits that cannot be packed, and a key has one for each day. So the days stored of a key become the bits of some
    words, which meet the batch by key alone: where both sides lie by key already, no day is shuffled or sorted.
    """
    number, word = F.unix_date(day), F.shiftright(F.unix_date(day), 6)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), number.bitwiseAND(63))
    words = target.where(F.col(day).isNotNull()).groupBy(*keys, word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    stored = words.groupBy(*[F.col(k).alias(f"_stored_{k}") for k in keys]).agg(
        F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_words")
    )
    same = reduce(lambda x, y: x & y, [F.col(k) == F.col(f"_stored_{k}") for k in keys])
    has = F.getbit(F.try_element_at("_words", word), number.bitwiseAND(63)) == 1
    return batch.join(stored.hint("shuffle_hash"), same & has, "left_anti")


def _any_row(df: DataFrame) -> Column:
    """Scalar subquery: does ``df`` hold a row? Stops at the first one."""
    return df.limit(1).agg((F.count(F.lit(1)) > 0).alias("any")).scalar()


def attach_max(df: DataFrame, value: Column, name: str, over: DataFrame | None = None) -> DataFrame:
    """``df`` plus the overall maximum of ``value`` as a column.

    A scalar subquery: one aggregate with a partial step per partition, where
    an unpartitioned window would pull every row into a single task.
    """
    source = df if over is None else over
    return df.withColumn(name, source.agg(F.max(value).alias(name)).scalar())


def incremental_load(
    batch: DataFrame,
    target: DataFrame,
    key: str = "_row_id",
    latest: str = "flip_if_new",
    order: str | None = None,
    fresh: DataFrame | None = None,
) -> DataFrame:
    """The table after loading ``batch`` into ``target``.

    ``order`` names the date (``max_of_batch``) or the sync time
    (``max_sync_minute``). ``fresh`` may pass in :func:`new_rows` already
    computed and persisted by the caller.
    """
    if latest not in POLICIES:
        raise ValueError(f"unknown policy {latest!r}")
    if fresh is None:
        fresh = new_rows(batch, target, key)
    if latest == "keep":
        return target.unionByName(fresh)
    if latest == "max_of_batch":
        both = target.drop("latest").unionByName(fresh.drop("latest"))
        newest = attach_max(both, F.col(order), "_newest")
        return newest.withColumn("latest", F.coalesce(F.col(order) == F.col("_newest"), F.lit(False))).drop("_newest")
    if latest == "max_sync_minute":
        both = target.drop("latest").unionByName(fresh.drop("latest"))
        minute = F.date_trunc("minute", F.col(order))
        newest = attach_max(both, minute, "_newest", over=batch)
        return newest.withColumn("latest", F.coalesce(minute == F.col("_newest"), F.lit(False))).drop("_newest")

    fresh = fresh.withColumn("latest", F.lit(True))
    if latest == "flip_all":
        old = target.withColumn("latest", F.lit(False))
    elif latest == "flip_matched":
        seen = batch.select(key).distinct().withColumn("_seen", F.lit(True))
        gone = F.coalesce(F.col("_seen"), F.lit(False)) & _any_row(fresh)
        old = (
            target.join(seen, key, "left")
            .withColumn("latest", F.col("latest") & ~gone)
            .select(target.columns)
        )
    else:  # flip_if_new, flip_true_only
        old = target.withColumn("latest", F.col("latest") & ~_any_row(fresh))
    return old.unionByName(fresh.select(target.columns))


def load_counts(batch: DataFrame, target: DataFrame, key: str = "_row_id") -> DataFrame:
    """One lazy row: new rows, table size before and after the load."""
    news = new_rows(batch, target, key).agg(F.count(F.lit(1)).alias("n")).scalar()
    return target.agg(F.count(F.lit(1)).alias("rows_before")).select(
        news.alias("rows_new"), "rows_before", (F.col("rows_before") + news).alias("rows_after")
    )


def load_stats(batch: DataFrame, target: DataFrame, key: str = "_row_id") -> LoadStats:
    row = load_counts(batch, target, key).first()
    return LoadStats(row["rows_new"], row["rows_before"], row["rows_after"])


def _row_hash(df: DataFrame, seed: int) -> Column:
    """64-bit hash of a row. The hash passes over NULLs, so their places go in as text; nested values go in as JSON."""
    fields = [(F.col(f"`{f.name}`"), isinstance(f.dataType, (T.StructType, T.ArrayType))) for f in df.schema]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c, _ in fields])
    return F.xxhash64(F.lit(seed), nulls, *[F.to_json(c) if nested else c for c, nested in fields])


def _differing_groups(new: DataFrame, old: DataFrame) -> DataFrame:
    """Groups of rows in which the two frames differ, by the number of rows and the sums of two hashes of each group.

    The order of rows plays no part. Hashes are summed by halves, which stay far from overflow.
    """

    def signed(df: DataFrame, sign: int) -> DataFrame:
        hashes = df.select(_row_hash(df, 1).alias("a"), _row_hash(df, 2).alias("b"))
        halves = {f"{h}{i}": half for h in "ab" for i, half in enumerate((F.shiftrightunsigned(h, 32), F.col(h).bitwiseAND(0xFFFFFFFF)))}
        return hashes.select(
            F.pmod("a", F.lit(GROUPS)).alias("_group"), F.lit(sign).cast("bigint").alias("n"),
            *[(half * sign).alias(name) for name, half in halves.items()],
        )

    sums = ["n", "a0", "a1", "b0", "b1"]
    both = signed(new, 1).unionByName(signed(old, -1)).groupBy("_group").agg(*[F.sum(c).alias(c) for c in sums])
    return both.filter(reduce(lambda x, y: x | y, [F.col(c) != 0 for c in sums])).select("_group")


def changed_rows(new: DataFrame, old: DataFrame, symmetric: bool = False) -> DataFrame:
    """Rows by which ``new`` differs from ``old`` (distinct, NULL-safe).

    One-directional by default, so a pure deletion does not count as a change.
    Digests of :data:`GROUPS` groups of rows are compared first, which moves one row a group and task; rows
    themselves are read again and shuffled only for groups that differ, and not at all where nothing has changed.
    """
    old = old.select(new.columns)
    groups = F.broadcast(_differing_groups(new, old))

    def doubtful(df: DataFrame) -> DataFrame:
        grouped = df.withColumn("_group", F.pmod(_row_hash(df, 1), F.lit(GROUPS)))
        return grouped.join(groups, "_group", "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])

    new, old = doubtful(new), doubtful(old)
    out = new.subtract(old)
    return out.unionByName(old.subtract(new)) if symmetric else out


def update_by_key(df: DataFrame, updates: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Set columns from ``updates`` where the key matches (a matched NULL is
    written too). ``updates`` must be unique on the key."""
    keys = [key] if isinstance(key, str) else list(key)
    values = [c for c in updates.columns if c not in keys]
    packed = updates.select(*keys, F.struct(*values).alias("_set"))
    joined = df.join(packed, keys, "left")
    out = [
        F.when(F.col("_set").isNotNull(), F.col(f"_set.{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
        for c in df.columns
    ]
    return joined.select(*out)


def update_column(df: DataFrame, name: str, value: Column, where: Column | None = None) -> DataFrame:
    """Column-wide update, optionally only on some rows."""
    return df.withColumn(name, value if where is None else F.when(where, value).otherwise(F.col(name)))


def latest_view(df: DataFrame, name: str | None = None) -> DataFrame:
    """Rows of the newest batch; registered as ``<name>_latest`` when named."""
    out = df.filter("latest")
    if name:
        out.createOrReplaceTempView(f"{name}_latest")
    return out


def union_sources(*frames: DataFrame) -> DataFrame:
    """UNION ALL of harmonised sources, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)
