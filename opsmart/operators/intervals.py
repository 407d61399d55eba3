"""Daily histories kept as intervals: one row for each known day of a key, valid until the next one.

A daily table that carries figures over quiet days grows with keys times days, however little happens. An
interval table grows with the snapshots only; days are unfolded where they are read, each row by itself, so
neither a join with the calendar nor a shuffle is needed for that. A snapshot that comes late splits the interval it falls into, and
figures carried from there on are put right (:func:`merge_late`); everything else in the table stays as it is.

Columns of an interval table: the keys and further columns of the snapshots, ``valid_from``, ``valid_to`` (NULL: up to now),
``is_first`` (no earlier row of the key), and for each carried column ``c`` its value and ``seen_c``, what the snapshot itself said.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _windows(keys: Sequence[str]):
    order = Window.partitionBy(*keys).orderBy("valid_from")
    return order, order.rowsBetween(Window.unboundedPreceding, 0)


def to_intervals(snapshots: DataFrame, keys: Sequence[str], day: str, carried: Sequence[str]) -> DataFrame:
    """Intervals of ``snapshots``, which hold at most one row for each key and ``day``; rows without a day are left out.

    One shuffle by the keys; a key has one row a day at most, so no window outgrows the calendar.
    """
    order, past = _windows(keys)
    rows = snapshots.where(F.col(day).isNotNull()).withColumns({"valid_from": F.col(day), **{f"seen_{c}": F.col(c) for c in carried}})
    return rows.withColumns(
        {
            "valid_to": F.date_sub(F.lead("valid_from").over(order), 1),
            "is_first": F.row_number().over(order) == 1,
            **{c: F.last(f"seen_{c}", ignorenulls=True).over(past) for c in carried},
        }
    )


def merge_late(history: DataFrame, late: DataFrame, keys: Sequence[str], day: str, carried: Sequence[str]) -> DataFrame:
    """``history`` after snapshots came in whatever order; of two for a key and day the late one counts.

    Only intervals of the late rows' keys that end on the day before the earliest of them or later are worked out anew; the
    first of these stands for all that came before. Others are handed through without a shuffle of their own
    (a small batch is broadcast to find them).
    """
    order, past = _windows(keys)
    since = late.where(F.col(day).isNotNull()).groupBy(*keys).agg(F.min(day).alias("_since"))
    marked = history.join(since, list(keys), "left")
    touched = F.col("_since").isNotNull() & (F.coalesce("valid_to", F.col("_since")) >= F.date_sub("_since", 1))
    kept = marked.where(~touched).select(history.columns)
    fresh = late.where(F.col(day).isNotNull()).withColumn("valid_from", F.col(day))
    fresh = fresh.withColumns({**{f"seen_{c}": F.col(c) for c in carried}, **{f"_carry_{c}": F.col(c) for c in carried}})
    before = F.col("valid_from") < F.col("_since")
    old = marked.where(touched).withColumns({f"_carry_{c}": F.when(before, F.col(c)).otherwise(F.col(f"seen_{c}")) for c in carried})
    old = old.drop("_since").join(fresh.select(*keys, "valid_from"), [*keys, "valid_from"], "left_anti")
    rows = old.unionByName(fresh, allowMissingColumns=True).withColumn("_was_first", F.coalesce("is_first", F.lit(True)))
    again = rows.withColumns(
        {
            "valid_to": F.date_sub(F.lead("valid_from").over(order), 1),
            "is_first": (F.row_number().over(order) == 1) & F.col("_was_first"),
            **{c: F.last(f"_carry_{c}", ignorenulls=True).over(past) for c in carried},
        }
    )
    return kept.unionByName(again.select(history.columns))


def clipped(history: DataFrame, first: Column | None = None, last: Column | None = None) -> DataFrame:
    """The part of every interval from ``first`` to ``last``; what begins before ``first`` is the first row no longer."""
    out = history
    if last is not None:
        out = out.where(F.col("valid_from") <= last).withColumn("valid_to", F.least(F.coalesce("valid_to", last), last))
    if first is not None:
        out = out.where(F.coalesce(F.col("valid_to") >= first, F.lit(True)))
        out = out.withColumns({"is_first": F.col("is_first") & (F.col("valid_from") >= first), "valid_from": F.greatest("valid_from", first)})
    return out


def append_after(stored: DataFrame, computed: DataFrame, keys: Sequence[str], until: Column) -> DataFrame:
    """``stored`` as it is up to ``until``, and ``computed`` from the next day on; keys not stored yet come in as a whole.

    This is the load that never touches a stored day, even if a late snapshot would change it.
    """
    known = stored.select(*keys).distinct().withColumn("_known", F.lit(True))
    marked = computed.join(known, list(keys), "left")
    new = marked.where(F.col("_known").isNull()).select(computed.columns)
    later = clipped(marked.where(F.col("_known").isNotNull()).select(computed.columns), first=F.date_add(until, 1))
    return clipped(stored, last=until).unionByName(later).unionByName(new)


def as_of(history: DataFrame, day: Column) -> DataFrame:
    """The rows valid on ``day``, one for each key known by then."""
    return history.where((F.col("valid_from") <= day) & F.coalesce(F.col("valid_to") >= day, F.lit(True)))


def unfold(
    history: DataFrame, day: str, carried: Sequence[str], start: Column, end: Column, only_on_day: Sequence[str] = (), name: str = "date"
) -> DataFrame:
    """Every key on every day of ``[start, end]``: ``carried`` columns as known by then, ``only_on_day`` columns on their own ``day``.

    Days before a key's first row are there with empty figures. Rows from before ``start`` are carried in.
    """
    first = F.when(F.col("is_first"), start).otherwise(F.greatest("valid_from", start))
    last = F.least(F.coalesce("valid_to", end), end)
    rows = history.withColumns({"_first": first, "_last": last}).where("_first <= _last")
    days = rows.withColumn(name, F.explode(F.sequence("_first", "_last", F.expr("interval 1 day"))))
    known, here = F.col(name) >= F.col("valid_from"), F.col(name) == F.col(day)
    out = days.withColumns({**{c: F.when(known, F.col(c)) for c in carried}, **{c: F.when(here, F.col(c)) for c in only_on_day}})
    return out.drop("_first", "_last", "valid_from", "valid_to", "is_first", *[f"seen_{c}" for c in carried], *([day] if day != name else []))
