"""Loaded tables as Spark's own tables, with ``latest`` as a view.

A table ``t`` of a store is a database of the session's catalog holding

* ``t__rows<g>``, partitioned by ``_batch``: every load inserts its unseen rows as one more batch,
* ``t__seen_<key>`` (policy ``flip_matched`` only): ids of stored rows that a batch delivered again,
* ``t``, a view over the batches that count, which also says what ``latest`` is.

No row is rewritten: the flag follows from the batch a row lies in, from a maximum, or from the re-delivered ids, and
the view spells that out in SQL, so that any SQL user reads the same table. Replacing the view is what makes a load count: one that fails
half-way leaves the view as it was, and the next one drops the batch it left. A frame that was read
keeps the batches it saw, so a table may be read while its successor is computed from it. A table has one writer at a time.

On a cluster the session's catalog has to be a lasting one (a metastore) and ``location`` a shared folder.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from opsmart.operators import load as ops
from opsmart.operators.quality import Watch
from opsmart.session import materialise

BATCH = "_batch"
FLIPS = ("flip_all", "flip_if_new", "flip_true_only")


def _once(batch: DataFrame, key: str) -> DataFrame:
    """One row for each key; rows without a key are told apart by a number of their own."""
    lone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    return batch.withColumn("_lone", lone).dropDuplicates([key, "_lone"]).drop("_lone")


def _quoted(text: str | int) -> str:
    """The inside of a text literal of SQL."""
    return str(text).replace("\\", "\\\\").replace("'", "\\'")


def _shape(schema: StructType) -> dict:
    return {f.name: f.dataType for f in schema if f.name != BATCH}


@dataclass(frozen=True)
class _State:
    """What the view of a table says: its rows table, the batches that count, how loads flag rows, and the figures
    they took (a JSON object of columns and figures; empty if a batch was loaded without)."""

    rows: str
    base: int
    top: int
    policy: str = ""
    key: str = ""
    order: str = ""
    watched: str = ""


class TableStore:
    def __init__(self, spark: SparkSession, location: str, database: str | None = None):
        self.spark = spark
        self.database = database or "store_" + hashlib.sha256(location.encode()).hexdigest()[:16]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{_quoted(location)}'")

    def name(self, table: str) -> str:
        """The table's name in SQL."""
        return f"`{self.database}`.`{table}`"

    # ---- state ------------------------------------------------------------

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def _state(self, table: str) -> _State | None:
        if not self.exists(table):
            return None
        p = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()}
        return _State(p["rows"], int(p["base"]), int(p["top"]), p["policy"], p["key"], p["order"], p.get("watched", ""))

    def batch(self, table: str) -> int | None:
        """Number of the newest batch that counts."""
        state = self._state(table)
        return state.top if state else None

    def _show(self, table: str, state: _State) -> None:
        """Make ``state`` what the table is."""
        columns = [c for c in self.spark.table(self.name(state.rows)).columns if c != BATCH]
        span = f"{BATCH} BETWEEN {state.base} AND {state.top}"
        joined, flag = "", ""
        if state.policy and state.policy != "keep":
            held = "latest" in columns
            columns = [c for c in columns if c != "latest"]
            order = f"r.`{state.order}`"
            if state.policy in FLIPS:
                flag = f"r.{BATCH} = {state.top}"
            elif state.policy == "flip_matched":
                seen = self.name(self._seen(table, state.key))
                joined = f" LEFT JOIN (SELECT DISTINCT `{state.key}` AS again FROM {seen} WHERE {BATCH} BETWEEN {state.base + 1} AND {state.top}) s ON s.again = r.`{state.key}`"
                flag = ("coalesce(r.latest, true) AND " if held else "") + "s.again IS NULL"
            elif state.policy == "max_of_batch":
                flag = f"coalesce({order} = (SELECT max(`{state.order}`) FROM {self.name(state.rows)} WHERE {span}), false)"
            else:
                minute = f"(SELECT max(date_trunc('minute', `{state.order}`)) FROM {self.name(state.rows)} WHERE {BATCH} = {state.top})"
                flag = f"coalesce(date_trunc('minute', {order}) = {minute}, false)"
        chosen = ", ".join([f"r.`{c}`" for c in columns] + ([f"{flag} AS latest"] if flag else []))
        properties = ", ".join(f"'{k}' = '{_quoted(v)}'" for k, v in vars(state).items())
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name(table)} TBLPROPERTIES ({properties}) AS "
            f"SELECT {chosen} FROM {self.name(state.rows)} r{joined} WHERE r.{span}"
        )

    @staticmethod
    def _seen(table: str, key: str) -> str:
        return f"{table}__seen_{key.strip('_')}"

    # ---- reading ----------------------------------------------------------

    def read(self, table: str) -> DataFrame:
        if not self.exists(table):
            raise FileNotFoundError(f"no table {table} in {self.database}")
        return self.spark.table(self.name(table))

    def _stored(self, state: _State) -> DataFrame:
        return self.spark.table(self.name(state.rows)).where(F.col(BATCH).between(state.base, state.top))

    # ---- writing ----------------------------------------------------------

    def _insert(self, rows: str, df: DataFrame, number: int, watch: Watch | None = None) -> dict:
        """Insert ``df`` as batch ``number`` in place of whatever a failed load left there; its figures, of which ``n`` is
        the number of its rows. All are taken while the rows are written."""
        name = self.name(rows)
        if not self.spark.catalog.tableExists(name):
            schema = StructType([*df.schema.fields, StructField(BATCH, IntegerType())])
            self.spark.createDataFrame([], schema).write.partitionBy(BATCH).format("parquet").saveAsTable(name)
        # Added first, so that files of a load that failed before its partition was known go as well.
        self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({BATCH} = {number})")
        self.spark.sql(f"ALTER TABLE {name} DROP PARTITION ({BATCH} = {number})")
        columns = [c for c in self.spark.table(name).columns if c != BATCH]
        missing = {c: F.lit(None) for c in columns if c not in df.columns}
        counted = Observation()
        figures = [F.count(F.lit(1)).alias("n"), *(watch.figures() if watch else [])]
        out = df.withColumns(missing).select(*columns).observe(counted, *figures).withColumn(BATCH, F.lit(number))
        out.write.mode("append").insertInto(name)
        return counted.get

    def write(self, table: str, df: DataFrame) -> DataFrame:
        """Replace the whole content; the old one counts until the new one is complete. Columns may change."""
        state = self._state(table)
        rows = state.rows if state else f"{table}__rows1"
        if state and _shape(self.spark.table(self.name(rows)).schema) != _shape(df.schema):
            rows = f"{table}__rows{int(rows.rpartition('rows')[2]) + 1}"
        number = state.top + 1 if state else 1
        self._insert(rows, df, number)
        self._show(table, _State(rows, number, number))
        return self.read(table)

    # Full refresh and whole-table clone are the same act here.
    full_refresh = write
    snapshot = write

    def compact(self, table: str) -> DataFrame:
        """Fold all batches into one."""
        return self.write(table, self.read(table))

    def _settled(self, table: str, policy: str, key: str, order: str) -> _State | None:
        """The state to which a batch of this policy can be added; batches of another one are folded first."""
        state = self._state(table)
        if state and state.policy and (state.policy, state.order) != (policy, order):
            self.compact(table)
            state = self._state(table)
        return state

    def _add(self, table: str, df: DataFrame, state: _State | None, policy: str, key: str = "", order: str = "", always: bool = True,
             watch: Watch | None = None) -> int:
        rows, base, top = (state.rows, state.base, state.top) if state else (f"{table}__rows1", 1, 0)
        taken = self._insert(rows, df, top + 1, watch)
        if taken["n"] or always or not state:
            self._show(table, _State(rows, base, top + 1, policy, key, order, self._watched(state, watch, taken)))
        return taken["n"]

    @staticmethod
    def _watched(state: _State | None, watch: Watch | None, taken: dict) -> str:
        """The figures of the table with one more batch; none once a batch comes without, or with others."""
        told = json.loads(state.watched) if state and state.watched else {}
        if not watch or (state and told.get("watch") != [list(watch.not_null), watch.synced]):
            return ""
        return json.dumps({"watch": [list(watch.not_null), watch.synced], "figures": watch.added(told.get("figures", {}), taken)})

    def checks(self, table: str) -> tuple[Watch, dict, str] | None:
        """The checks that all loads of a table took, their figures over the whole table, and the key that loads keep unique.
        None if a batch was loaded without. Reads no row."""
        state = self._state(table)
        if not state or not state.watched:
            return None
        told = json.loads(state.watched)
        return Watch(tuple(told["watch"][0]), told["watch"][1]), told["figures"], state.key

    def append(self, table: str, df: DataFrame) -> DataFrame:
        """Append without looking for duplicates; a ``latest`` column is data here."""
        self._add(table, df, self._settled(table, "keep", "", ""), "keep")
        return self.read(table)

    def append_batch(self, table: str, df: DataFrame, latest: str = "flip_all") -> int:
        """Append all rows of a batch, which then is the latest one; the number of its rows."""
        return self._add(table, df.drop("latest"), self._settled(table, latest, "", ""), latest)

    def update(self, table: str, column: str, value: Column) -> DataFrame:
        return self.write(table, ops.update_column(self.read(table), column, value))

    def load(self, table: str, batch: DataFrame, key: str = "_row_id", latest: str = "flip_if_new", order: str | None = None,
             watch: Watch | None = None) -> ops.LoadStats:
        """Incremental load with counts: appends the rows whose key is new.

        Rows that repeat a key inside the batch are cut to one; rows without a key
        all stay. The batch is computed once: its new rows are counted while they are
        written. A load without any leaves the table as it is, except under
        ``flip_all``, which takes the flag off all rows even then. ``watch`` takes checks in the same pass, see :meth:`checks`.
        """
        if latest not in ops.POLICIES:
            raise ValueError(f"unknown policy {latest!r}")
        batch = _once(batch if latest == "keep" else batch.drop("latest"), key)
        state = self._settled(table, latest, key, order or "")
        before, fresh = 0, batch
        if state:
            stored = self._stored(state)
            before = stored.count()
            fresh = ops.new_rows(batch, stored, key)
        if latest == "flip_matched":
            ids = self._stored(state).select(key) if state else batch.select(key).limit(0)
            again = ids.join(batch.select(key), key, "left_semi").distinct()
            self._insert(self._seen(table, key), again, (state.top if state else 0) + 1)
        new = self._add(table, fresh, state, latest, key, order or "", always=latest == "flip_all", watch=watch)
        return ops.LoadStats(new, before, before + new)

    def upsert(self, table: str, rows: DataFrame, by: str, keys: Sequence[str]) -> list[str]:
        """Put ``rows`` in the place of stored rows with the same ``keys``, of which ``by`` is one, such as a day.

        The table is partitioned by ``by``. Only partitions that occur in ``rows`` are read and overwritten; the others are not touched.
        Returns them. The same rows again change nothing, so a replayed batch does no harm.
        """
        name = self.name(table)
        if not self.spark.catalog.tableExists(name):
            self.spark.createDataFrame([], rows.schema).write.partitionBy(by).format("parquet").saveAsTable(name)
        stored = self.spark.table(name)
        others = stored.join(rows.select(by).distinct(), by, "left_semi").join(rows.select(*keys), list(keys), "left_anti")
        touched = Observation()
        # Written first: a table cannot be overwritten while it is read.
        out = materialise(others.select(stored.columns).unionByName(rows.select(stored.columns)), "upsert")
        out = out.observe(touched, F.collect_set(F.col(by).cast("string")).alias("groups"))
        conf, setting = out.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"  # insertInto takes no options
        before = conf.get(setting)
        conf.set(setting, "dynamic")
        try:
            out.write.mode("overwrite").insertInto(name)
        finally:
            conf.set(setting, before)
        return sorted(touched.get["groups"])

    def replace_if_changed(self, table: str, new: DataFrame, symmetric: bool = False) -> tuple[bool, int]:
        """Replace the table only when rows were added or altered."""
        if not self.exists(table):
            return True, self.write(table, new).count()
        n = ops.changed_rows(new, self.read(table), symmetric).count()
        if n:
            self.write(table, new)
        return n > 0, n

    def vacuum(self, table: str) -> None:
        """Drop batches and row tables that no longer count. Frames read before must be done with."""
        state = self._state(table)
        kept = {state.rows, self._seen(table, state.key)}
        for t in self.spark.catalog.listTables(self.database):
            if t.name.startswith((f"{table}__rows", f"{table}__seen_")):
                if t.name not in kept:
                    self.spark.sql(f"DROP TABLE {self.name(t.name)}")
                    continue
                for r in self.spark.sql(f"SHOW PARTITIONS {self.name(t.name)}").collect():
                    number = int(r["partition"].partition("=")[2])
                    if not state.base <= number <= state.top:
                        self.spark.sql(f"ALTER TABLE {self.name(t.name)} DROP PARTITION ({BATCH} = {number})")
