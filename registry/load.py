"""Row ids, incremental loads, change gates, the table store, quality, streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsmart.functions.keys import file_line_id, row_id, sync_line_id
from opsmart.operators import load, quality
from opsmart.session import materialise, shared_dir
from opsmart.sources.store import TableStore
from opsmart.sources.tables import empty, read_drop, typed
from opsmart.streaming import daily_event_counts, dedupe_into, file_stream, ingest_drops, run_to_days
from registry import Sources, query

_ID = "sha256(_file || '-' || cast(_line as varchar)) as _row_id"
_COLS = "_file, _line, report_date, _modified, customer_id, priority, cast(amount as double) as amount"
_OLD = f"old as (select *, {_ID} from {{stored_drops}})"
_BATCH = f"batch as (select *, {_ID} from {{arriving_drops}})"
_BOTH = f"{_OLD}, {_BATCH}, fresh as (select * from batch where _row_id not in (select _row_id from old))"


def with_id(df):
    return df.withColumn("_row_id", file_line_id())


def flagged(df):
    return df.withColumn("latest", F.lit(True))


def shown(df):
    return df.withColumn("amount", F.col("amount").cast("double"))


def _load(policy: str, order: str | None = None):
    def build(s: Sources):
        batch, target = with_id(s.arriving_drops), flagged(with_id(s.stored_drops))
        # The new rows are asked for several times; written once, the big tables are scanned once for them.
        fresh = materialise(load.new_rows(batch, target), "fresh")
        return shown(load.incremental_load(batch, target, latest=policy, order=order, fresh=fresh))

    return build


query(
    "row_ids",
    f"""select _file, _line, {_ID}, sha256(priority || '-' || cast(report_date as varchar) || '-' || cast(customer_id as varchar)) as business_id,
        sha256(strftime(_modified, '%Y-%m-%d %H:%M:%S.%f') || '-' || cast(_line as varchar)) as sync_id,
        sha256(nullif(priority, '5-LOW') || '-' || cast(_line as varchar)) as nullable_id
    from {{drops}}""",
)(
    lambda s: with_id(s.drops).select(
        "_file", "_line", "_row_id",
        row_id("priority", "report_date", "customer_id").alias("business_id"),
        sync_line_id("_modified").alias("sync_id"),
        row_id(F.nullif(F.col("priority"), F.lit("5-LOW")), "_line").alias("nullable_id"),
    )
)

query(
    "load_flip_all",
    f"with {_BOTH} select {_COLS}, _row_id, false as latest from old union all select {_COLS}, _row_id, true from fresh",
)(_load("flip_all"))

query(
    "load_flip_if_new",
    f"""with {_BOTH} select {_COLS}, _row_id, (select count(*) from fresh) = 0 as latest from old
    union all select {_COLS}, _row_id, true from fresh""",
)(_load("flip_if_new"))

query(
    "load_flip_true_only",
    f"""with {_BOTH} select {_COLS}, _row_id, (select count(*) from fresh) = 0 as latest from old
    union all select {_COLS}, _row_id, true from fresh""",
)(_load("flip_true_only"))

query(
    "load_flip_matched",
    f"""with {_BOTH} select {_COLS}, _row_id, not (_row_id in (select _row_id from batch) and (select count(*) from fresh) > 0) as latest from old
    union all select {_COLS}, _row_id, true from fresh""",
)(_load("flip_matched"))

query(
    "load_max_of_batch",
    f"""with {_BOTH}, merged as (select * from old union all select * from fresh)
    select {_COLS}, _row_id, report_date = (select max(report_date) from merged) as latest from merged""",
)(_load("max_of_batch", "report_date"))

query(
    "load_max_sync_minute",
    f"""with {_BOTH}
    select {_COLS}, _row_id, false as latest from old
    union all select {_COLS}, _row_id, date_trunc('minute', _modified) = (select max(date_trunc('minute', _modified)) from batch) from fresh""",
)(_load("max_sync_minute", "_modified"))


@query("load_replay_is_empty", f"with {_OLD} select {_COLS}, _row_id, true as latest from old")
def _(s):
    """Delivering the stored rows again changes nothing, flags included."""
    target = flagged(with_id(s.stored_drops))
    return shown(load.incremental_load(with_id(s.stored_drops), target, latest="flip_matched"))


@query(
    "load_stats",
    f"""with {_BOTH} select (select count(*) from fresh) as rows_new, (select count(*) from old) as rows_before,
        (select count(*) from old) + (select count(*) from fresh) as rows_after""",
)
def _(s):
    return load.load_counts(with_id(s.arriving_drops), with_id(s.stored_drops))


_SHOW_PART = "select p_partkey, p_name, p_brand"


@query(
    "replace_if_changed",
    """select p_partkey, case when p_size > 45 then upper(p_name) else p_name end as p_name, nullif(p_brand, 'Brand#7') as p_brand from {part}
    except select p_partkey, p_name, nullif(p_brand, 'Brand#7') from {part}""",
)
def _(s):
    old = s.part.select("p_partkey", "p_name", F.nullif(F.col("p_brand"), F.lit("Brand#7")).alias("p_brand"))
    new = old.join(s.part.select("p_partkey", "p_size"), "p_partkey").select(
        "p_partkey", F.when(F.col("p_size") > 45, F.upper("p_name")).otherwise(F.col("p_name")).alias("p_name"), "p_brand"
    )
    return load.changed_rows(new, old)


@query(
    "replace_if_changed_symmetric",
    """with a as (select p_brand, p_type from {part} where p_size < 30), b as (select p_brand, p_name as p_type from {part} where p_size > 20 union select p_brand, p_type from {part} where p_size > 28)
    (select * from a except select * from b) union all (select * from b except select * from a)""",
)
def _(s):
    a = s.part.filter("p_size < 30").select("p_brand", "p_type")
    b = s.part.filter("p_size > 20").select("p_brand", F.col("p_name").alias("p_type")).union(
        s.part.filter("p_size > 28").select("p_brand", "p_type")
    )
    return load.changed_rows(a, b, symmetric=True)


@query(
    "mapping_incremental",
    """select n_nationkey as id, n_name as name from {nation} where n_regionkey < 2
    union all select s_suppkey, s_name from {supplier} s
    where not exists (select 1 from {nation} n where n_regionkey < 2 and n.n_nationkey = s.s_suppkey)""",
)
def _(s):
    target = s.nation.filter("n_regionkey < 2").select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"))
    batch = s.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return load.incremental_load(batch, target, key="id", latest="keep")


@query(
    "update_by_key",
    """select c.c_custkey, c.c_name, case when o.k is not null then o.priority else c.c_mktsegment end as c_mktsegment
    from {customer} c left join (select o_custkey as k, nullif(min(o_orderpriority), '2-HIGH') as priority from {orders}
        where o_totalprice > 400000 group by 1) o on o.k = c.c_custkey""",
)
def _(s):
    updates = s.orders.filter("o_totalprice > 400000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.nullif(F.min("o_orderpriority"), F.lit("2-HIGH")).alias("c_mktsegment")
    )
    return load.update_by_key(s.customer.select("c_custkey", "c_name", "c_mktsegment"), updates, "c_custkey")


@query(
    "update_column",
    """select sku, regexp_replace(item_description, '\\s', '', 'g') as item_description from {dirty_items}""",
)
def _(s):
    items = s.dirty_items.select("sku", "item_description")
    return load.update_column(items, "item_description", F.regexp_replace("item_description", r"\s", ""))


@query(
    "latest_view",
    f"with {_BOTH} select {_COLS}, _row_id, true as latest from fresh",
)
def _(s):
    loaded = _load("flip_if_new")(s)
    return load.latest_view(loaded)


@query("union_sources", """select sku, inv_date, on_hand from {wms_snapshots} union all select sku, inv_date, on_hand from {tpl_snapshots}""")
def _(s):
    cols = ["sku", "inv_date", "on_hand"]
    return load.union_sources(s.wms_snapshots.select(cols), s.tpl_snapshots.select(cols))


# ---- table store and file drops --------------------------------------------


@query("store_load", f"with {_BOTH} select {_COLS}, _row_id, false as latest from old union all select {_COLS}, _row_id, true from fresh")
def _(s):
    """Two loads through the versioned store, the second one delivered twice."""
    store = TableStore(s.spark, shared_dir(s.spark, "store"))
    store.load("drops", with_id(s.stored_drops))
    store.load("drops", with_id(s.arriving_drops))
    store.load("drops", with_id(s.arriving_drops))
    return shown(store.read("drops"))


_ITEM = T.StructType().add("id", "long").add("name", "string").add("weight", "double").add("latest", "boolean")


@query("first_load", "select p_partkey as id, p_name as name, true as latest from {part}")
def _(s):
    """A typed table without rows and a typed copy without rows take their first load; a column is dropped afterwards."""
    items = s.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    target = empty(s.spark, _ITEM).unionByName(typed(items.filter(F.lit(False)), _ITEM))
    batch = typed(items, _ITEM).drop("latest")
    return load.incremental_load(batch, target, key="id").drop("weight")


_WATCH = quality.Watch(("customer_id", "amount", "priority"), "_modified")


@query(
    "load_checks",
    f"""with {_BOTH}, t as (select * replace (nullif(priority, '2-HIGH') as priority) from (select * from old union all select * from fresh))
    select 'not_null(customer_id)' as "check", count(*) filter (customer_id is null) as failures, count(*) filter (customer_id is null) = 0 as passed from t
    union all select 'not_null(amount)', count(*) filter (amount is null), count(*) filter (amount is null) = 0 from t
    union all select 'not_null(priority)', count(*) filter (priority is null), count(*) filter (priority is null) = 0 from t
    union all select 'unique(_row_id)', count(*) - count(distinct _row_id), count(*) = count(distinct _row_id) from t
    union all select 'newest ' || strftime(max(_modified), '%Y-%m-%d %H:%M:%S'), count(*) filter (_modified is null), max(_modified) is not null from t""",
)
def _(s):
    """Checks taken by two loads while they write, and the newest sync time; no row of the table is read for them."""
    store = TableStore(s.spark, shared_dir(s.spark, "store"))
    for drops in (s.stored_drops, s.arriving_drops):
        store.load("drops", with_id(drops).withColumn("priority", F.nullif("priority", F.lit("2-HIGH"))), watch=_WATCH)
    watch, figures, key = store.checks("drops")
    newest = watch.synced_table(s.spark, figures).select(
        F.concat(F.lit("newest "), F.date_format(watch.synced, "yyyy-MM-dd HH:mm:ss")).alias("check"),
        F.lit(0).cast("bigint").alias("failures"), F.col(watch.synced).isNotNull().alias("passed"),
    )
    return watch.report(s.spark, figures, key).unionByName(newest)


@query("append_and_refresh", """select p_type as kind, count(*) * 2 as n from {part} group by p_type union all select 'all' as kind, count(*) from {part}""")
def _(s):
    store = TableStore(s.spark, shared_dir(s.spark, "store"))
    by_type = s.part.groupBy(F.col("p_type").alias("kind")).agg((F.count("*") * 2).alias("n"))
    total = s.part.agg(F.count("*").alias("n")).select(F.lit("all").alias("kind"), "n")
    store.full_refresh("counts", total)
    store.full_refresh("counts", by_type)
    return store.append("counts", total)


@query("snapshot_clone", "select 'nation' as name, count(*) as n, sum(n_nationkey) as keys from {nation} union all select 'part', count(*), sum(p_partkey) from {part}")
def _(s):
    """Whole-table clones, schema following the source."""
    store = TableStore(s.spark, shared_dir(s.spark, "clones"))
    copies = {"nation": store.snapshot("nation", s.nation), "part": store.snapshot("part", s.part)}
    parts = [
        copies[t].agg(F.count("*").alias("n"), F.sum(k).alias("keys")).select(F.lit(t).alias("name"), "n", "keys")
        for t, k in (("nation", "n_nationkey"), ("part", "p_partkey"))
    ]
    return parts[0].union(parts[1])


@query("read_csv_drop", "select _line, report_date, cast(amount as double) as amount, priority, true as has_lineage from {drops}")
def _(s):
    """Writes the drops as CSV files and scans them with their lineage."""
    folder = shared_dir(s.spark, "csv")
    cols = ["_line", "report_date", "amount", "priority"]
    source = s.drops.select(cols)
    source.write.option("header", True).csv(folder)
    back = read_drop(s.spark, folder, source.schema)
    lineage = F.col("_file").isNotNull() & F.col("_modified").isNotNull()
    return back.select("_line", "report_date", F.col("amount").cast("double").alias("amount"), "priority", lineage.alias("has_lineage"))


# ---- quality ----------------------------------------------------------------


@query(
    "quality_unique",
    """select 'unique(l_orderkey)' as "check", count(*) as failures, count(*) = 0 as passed from (select l_orderkey from {lineitem} group by 1 having count(*) > 1)
    union all select 'unique(o_orderkey)', count(*), count(*) = 0 from (select o_orderkey from {orders} group by 1 having count(*) > 1)""",
)
def _(s):
    return quality.unique_check(s.lineitem, "l_orderkey").union(quality.unique_check(s.orders, "o_orderkey"))


@query(
    "quality_not_null",
    """select 'not_null(customer_id)' as "check", count(*) as failures, count(*) = 0 as passed from {shop_orders} where customer_id is null
    union all select 'not_null(order_id)', count(*), count(*) = 0 from {shop_orders} where order_id is null""",
)
def _(s):
    return quality.not_null_check(s.shop_orders, "customer_id").union(quality.not_null_check(s.shop_orders, "order_id"))


@query("quality_duplicates", "select l_orderkey, count(*) as n_rows from {lineitem} where l_orderkey is not null group by 1 having count(*) > 1")
def _(s):
    return quality.duplicates(s.lineitem, "l_orderkey")


_HOURS = "date_diff('second', max(cast(o_orderdate as timestamp)), timestamp '{0}') / 3600.0::double"


def _fresh_sql(as_of: str) -> str:
    age = _HOURS.format(as_of)
    return f"""select max(o_orderdate) as newest, {age} as age_hours,
        case when {age} > 72 then 'error' when {age} > 48 then 'warn' else 'pass' end as status from {{orders}}"""


_AS_OF = ["2001-08-02 12:00:00", "2001-08-03 13:30:00", "2001-08-05 01:00:00"]


@query("freshness", " union all ".join(_fresh_sql(a) for a in _AS_OF))
def _(s):
    parts = [quality.freshness(s.orders, "o_orderdate", a) for a in _AS_OF]
    out = parts[0].union(parts[1]).union(parts[2])
    return out.withColumn("newest", F.col("newest").cast("timestamp_ntz"))


_UPDATES = """select 'sales' as schema_name, 'orders' as table_name, max(o_orderdate) as last_updated from {orders}
    union all select 'sales', 'lineitem', max(l_shipdate) from {lineitem}
    union all select 'site', 'events', date_trunc('second', max(ts)) from {events}"""


def _updates(s):
    return quality.last_updated(
        {
            ("sales", "orders"): (s.orders, "o_orderdate"),
            ("sales", "lineitem"): (s.lineitem, "l_shipdate"),
            ("site", "events"): (s.events.select(F.date_trunc("second", F.col("ts")).alias("ts")), "ts"),
        }
    )


def _wall_clock(df):
    return df.withColumn("last_updated", F.col("last_updated").cast("timestamp_ntz"))


@query("last_updated", _UPDATES)
def _(s):
    return _wall_clock(_updates(s))


@query("object_array", _UPDATES)
def _(s):
    """The last-updated list packed into an array of objects and unfolded again."""
    packed = quality.as_object_array(_updates(s))
    types = {"schema_name": "string", "table_name": "string", "last_updated": "timestamp"}
    return _wall_clock(quality.flatten_objects(packed, "updates", types))


@query("variant_flatten", """select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, event_type as kind from {events}""")
def _(s):
    """Events as VARIANT arrays of objects, unfolded with typed fields."""
    packed = s.events.select(
        F.parse_json(
            F.concat(
                F.lit('[{"event_id":'), F.col("event_id").cast("string"), F.lit(',"kind":"'), F.col("event_type"),
                F.lit('","k":'), F.get_json_object("props", "$.k"), F.lit("}]"),
            )
        ).alias("v")
    )
    return quality.flatten_objects(packed, "v", {"event_id": "bigint", "k": "bigint", "kind": "string"})


# ---- streams ------------------------------------------------------------------


def _event_files(s: Sources) -> str:
    """Glob that matches the events table, be it one file or a folder."""
    return f"{s.folder}/event[s].parquet"


@query("stream_ingest", """select event_id, user_id, event_type, value, sha256(event_type || '-' || cast(event_id as varchar)) as _row_id, true as latest from {events}""")
def _(s):
    """Files waiting in a folder, loaded once although they are delivered twice."""
    home = shared_dir(s.spark, "ingest")
    store = TableStore(s.spark, f"{home}/tables")

    def parse(batch):
        return batch.select("event_id", "user_id", "event_type", "value", row_id("event_type", "event_id").alias("_row_id"))

    for delivery in ("first", "again"):
        stream = file_stream(s.spark, _event_files(s), s.events.schema)
        ingest_drops(stream, parse, store, "events", f"{home}/checkpoint-{delivery}").awaitTermination()
    return store.read("events")


#: Files of a delivery, so that no task reads or writes a delivery alone; a batch takes as many.
_FILES = 8


def _files_newest_first(s: Sources, home: str, copies: int = 2, parts: int = 5) -> str:
    """The events, each ``copies`` times, in deliveries of ascending age: the latest events come first."""
    share = F.ntile(parts).over(Window.orderBy(F.col("day").desc()))
    days = s.events.select(F.to_date("ts").alias("day")).distinct().select("day", share.alias("part"))  # one row a day
    rows = s.events.withColumn("day", F.to_date("ts")).join(days, "day")
    twice = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    # The second copy of an event comes one delivery later, with still older events.
    twice = twice.withColumn("part", F.col("part") + F.col("copy") - 1)
    for k in range(1, parts + copies):
        twice.where(F.col("part") == k).select(*s.events.columns).repartition(_FILES).write.mode("append").parquet(f"{home}/drops")
    return f"{home}/drops"


@query("stream_dedupe", "select event_id, event_type, value from {events}")
def _(s):
    """Every event sent twice, newest first, a delivery a batch: late first deliveries stay, repeats go."""
    home = shared_dir(s.spark, "dedupe")
    store = TableStore(s.spark, f"{home}/tables")
    stream = file_stream(s.spark, _files_newest_first(s, home), s.events.schema, files_per_trigger=_FILES)
    dedupe_into(stream.select("event_id", "event_type", "value"), "event_id", store, "events", f"{home}/checkpoint").awaitTermination()
    return store.read("events")


@query(
    "stream_daily",
    """select cast(ts as date) as date, event_type, count(*) as event_count, cast(sum(cast(value as decimal(18,2))) as double) as value from {events} group by 1, 2""",
)
def _(s):
    """Newest deliveries first, one a batch: every batch writes the days it touched, however late they come."""
    home = shared_dir(s.spark, "daily")
    stream = file_stream(s.spark, _files_newest_first(s, home, copies=1), s.events.schema, files_per_trigger=_FILES)
    counts = daily_event_counts(stream, "ts", "event_type", None, {"value": F.col("value").cast("decimal(18,2)")})
    out = run_to_days(counts, TableStore(s.spark, f"{home}/tables"), "daily", f"{home}/checkpoint", "event_type")
    return out.select("date", "event_type", "event_count", F.col("value").cast("double").alias("value"))
