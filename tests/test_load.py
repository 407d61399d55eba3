import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from opsmart.functions.keys import row_id
from opsmart.operators import load, quality
from opsmart.plans.refresh import refresh_in_order
from opsmart.sources.store import TableStore
from opsmart.sources.tables import empty, read_drop, read_table, rename, typed
from opsmart.schemas import DDL, schema

SCHEMA = "_row_id string, day date, synced timestamp, v int, latest boolean"
T1, T2 = dt.datetime(2023, 1, 1, 3, 0, 10), dt.datetime(2023, 1, 2, 3, 0, 50)


def rows(df):
    return {r["_row_id"]: (r["v"], r["latest"]) for r in df.collect()}


@pytest.fixture
def target(spark):
    return spark.createDataFrame(
        [("a", dt.date(2023, 1, 1), T1, 1, True), ("b", dt.date(2023, 1, 1), T1, 2, True), ("c", dt.date(2022, 1, 1), T1, 3, False)], SCHEMA
    )


@pytest.fixture
def batch(spark):
    return spark.createDataFrame(
        [("b", dt.date(2023, 1, 1), T2, 20, None), ("d", dt.date(2023, 1, 2), T2, 4, None), ("e", dt.date(2023, 1, 1), T1, 5, None)], SCHEMA
    ).drop("latest")


@pytest.mark.parametrize("policy, order, want", [
    ("flip_all", None, {"a": False, "b": False, "c": False, "d": True, "e": True}),
    ("flip_if_new", None, {"a": False, "b": False, "c": False, "d": True, "e": True}),
    ("flip_true_only", None, {"a": False, "b": False, "c": False, "d": True, "e": True}),
    ("flip_matched", None, {"a": True, "b": False, "c": False, "d": True, "e": True}),
    ("max_of_batch", "day", {"a": False, "b": False, "c": False, "d": True, "e": False}),
    ("max_sync_minute", "synced", {"a": False, "b": False, "c": False, "d": True, "e": False}),
])
def test_policies(target, batch, policy, order, want):
    out = rows(load.incremental_load(batch, target, latest=policy, order=order))
    assert {k: v[1] for k, v in out.items()} == want
    assert out["b"][0] == 2  # a re-delivered row is not overwritten


@pytest.mark.parametrize("policy, old_flags", [
    ("flip_all", {"a": False, "b": False, "c": False}),
    ("flip_if_new", {"a": True, "b": True, "c": False}),
    ("flip_matched", {"a": True, "b": True, "c": False}),
])
def test_nothing_new(target, policy, old_flags):
    out = rows(load.incremental_load(target.drop("latest"), target, latest=policy))
    assert {k: v[1] for k, v in out.items()} == old_flags


def test_unknown_policy(target, batch):
    with pytest.raises(ValueError):
        load.incremental_load(batch, target, latest="sometimes")


def test_null_ids_always_load(spark, target):
    batch = spark.createDataFrame([(None, None, None, 9, None)], SCHEMA).drop("latest")
    assert load.incremental_load(batch, target).count() == 4


def test_new_days_are_those_with_new_ids(spark):
    """Days around those stored, before 1970 too; some rows come twice, some lack a part of the key, and so the id."""
    def table(days, v):
        keys = [("W", "a"), ("W", "b"), ("N", "a"), ("N", None), (None, "a")]
        data = [(w, s, d, v) for i, (w, s) in enumerate(keys) for d in [*days[i:], days[0], None]]
        return spark.createDataFrame(data, "warehouse string, sku string, date date, v int").withColumn("_row_id", row_id("warehouse", "date", "sku"))

    first = dt.date(1969, 10, 1)
    stored = table([first + dt.timedelta(n) for n in range(40, 200, 3)], 1).where("not (warehouse = 'N' and sku = 'a')")
    batch = table([first + dt.timedelta(n) for n in range(0, 260)], 2)
    got = load.new_days(batch, stored, ["warehouse", "sku"], "date")
    want = load.new_rows(batch, stored).select(batch.columns)
    assert got.columns == batch.columns and 0 < want.count() < batch.count()
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    assert load.new_days(batch, stored.limit(0), ["warehouse", "sku"], "date").count() == batch.count()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.integers(0, 9), min_size=1), st.sets(st.integers(0, 9), min_size=1), st.sampled_from(["flip_if_new", "flip_matched"]))
def test_load_is_idempotent(spark, stored, arriving, policy):
    make = lambda ids: spark.createDataFrame([(str(i), i) for i in sorted(ids)], "_row_id string, v int")
    target = make(stored).withColumn("latest", F.lit(True))
    once = load.incremental_load(make(arriving), target, latest=policy)
    assert {r["_row_id"] for r in once.collect()} == {str(i) for i in stored | arriving}
    assert load.load_stats(make(arriving), once).new == 0
    twice = load.incremental_load(make(arriving), once, latest=policy)
    assert twice.count() == once.count()


def test_load_stats(target, batch):
    assert load.load_stats(batch, target) == load.LoadStats(new=2, before=3, after=5)


def test_changed_rows(spark):
    mk = lambda d: spark.createDataFrame(d, "k int, v string")
    old = mk([(1, "a"), (2, None), (3, "c")])
    assert load.changed_rows(mk([(2, None), (1, "a")]), old).count() == 0  # a deletion is no change
    assert load.changed_rows(mk([(2, None), (1, "a")]), old, symmetric=True).count() == 1
    assert load.changed_rows(mk([(1, "b"), (2, None)]), old).collect()[0]["v"] == "b"


ODD_ROWS = [
    (None, "a", 0.0, (None, "x"), [1, None]), ("a", None, 0.0, ("x", None), [None, 1]), ("a", None, -0.0, ("x", None), [None, 1]),
    (None, None, None, None, None), ("b", "c", float("nan"), (None, None), []),
]
ODD = "k string, v string, d double, s struct<a: string, b: string>, l array<int>"


def test_changed_rows_tells_places_of_nulls_apart(spark):
    mk = lambda d: spark.createDataFrame(d, ODD)
    for i, row in enumerate(ODD_ROWS[:2] + ODD_ROWS[3:]):
        for j, other in enumerate(ODD_ROWS[:2] + ODD_ROWS[3:]):
            assert load.changed_rows(mk([row]), mk([other])).count() == (i != j)
    assert load.changed_rows(mk(ODD_ROWS), mk(ODD_ROWS[::-1] * 2), symmetric=True).count() == 0  # order and repeats are no change
    assert load.changed_rows(mk([ODD_ROWS[1]]), mk([ODD_ROWS[2]]), symmetric=True).count() == 0  # 0.0 is -0.0
    assert load.changed_rows(mk([]), mk(ODD_ROWS)).count() == 0
    assert load.changed_rows(mk(ODD_ROWS[:2]), mk([])).count() == 2


def test_changed_rows_is_subtract(spark):
    a = spark.range(5000).selectExpr("id % 900 as k", "if(id % 7 = 0, null, id % 13) as v")
    b = spark.range(5000).selectExpr("id % 1000 as k", "if(id % 5 = 0, null, id % 13) as v")
    key = lambda df: sorted((r["k"], r["v"] is None, r["v"] or 0) for r in df.collect())
    assert key(load.changed_rows(a, b)) == key(a.subtract(b))
    assert key(load.changed_rows(a, b, symmetric=True)) == key(a.subtract(b).union(b.subtract(a)))


def test_unchanged_tables_shuffle_digests_only(spark, tmp_path):
    spark.range(20000).selectExpr("id", "cast(id as string) as v").write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    out = load.changed_rows(t, t)
    assert out.collect() == []
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Exchange" not in final  # nothing is left to do once no group differs


def test_load_takes_checks(spark, tmp_path, target, batch):
    watch = quality.Watch(("_row_id", "v"), "t")
    mk = lambda d: spark.createDataFrame(d, "_row_id string, v int, t timestamp")
    day = lambda n: dt.datetime(2024, 1, n)
    store = TableStore(spark, str(tmp_path))
    store.load("w", mk([("a", 1, day(2)), ("b", None, day(5)), (None, None, None), ("a", 1, day(2))]), watch=watch)
    store.load("w", mk([("b", None, day(9)), ("c", None, day(3)), ("it's", 2, None)]), watch=watch)
    store.load("w", mk([]), watch=watch)
    kept, figures, key = store.checks("w")
    got = {r["check"]: (r["failures"], r["passed"]) for r in kept.report(spark, figures, key).collect()}
    t = store.read("w")
    want = [quality.not_null_check(t, "_row_id"), quality.not_null_check(t, "v"), quality.unique_check(t, "_row_id")]
    assert got == {r["check"]: (r["failures"], r["passed"]) for w in want for r in w.collect()}
    assert got["not_null(v)"] == (3, False)
    now = "2024-01-09 00:00:00"
    assert quality.freshness(kept.synced_table(spark, figures), "t", now).collect() == quality.freshness(t, "t", now).collect()
    store.load("w", mk([("z", 1, day(4))]))  # a batch without checks: the figures no longer tell of the whole table
    assert store.checks("w") is None


def test_update_by_key_writes_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    assert {r["k"]: r["v"] for r in load.update_by_key(df, new, "k").collect()} == {1: "x", 2: None, 3: "c"}


def test_update_column_and_views(spark, target):
    assert rows(load.update_column(target, "v", F.lit(0), F.col("latest")))["c"][0] == 3
    load.latest_view(target, "things")
    assert spark.table("things_latest").count() == 2


def test_store(spark, tmp_path, target, batch):
    store = TableStore(spark, str(tmp_path))
    assert not store.exists("t")
    with pytest.raises(FileNotFoundError):
        store.read("t")
    store.write("t", target)
    assert store.load("t", batch) == load.LoadStats(2, 3, 5)
    assert store.batch("t") == 2
    assert store.load("t", batch) == load.LoadStats(0, 5, 5)
    assert store.batch("t") == 2  # nothing new: the table stays as it is
    assert {k: v[1] for k, v in rows(store.read("t")).items()} == {"a": False, "b": False, "c": False, "d": True, "e": True}
    assert store.append("t", store.read("t")).count() == 10
    assert store.update("t", "v", F.lit(7)).filter("v = 7").count() == 10
    seen = store.read("t")
    store.write("t", target)
    assert seen.count() == 10  # what was read before
    assert rows(store.read("t")) == rows(target)
    assert rows(spark.table(store.name("t"))) == rows(target)  # plain SQL users read the same
    store.vacuum("t")
    assert rows(store.read("t")) == rows(target)
    assert store.load("t", batch) == load.LoadStats(2, 3, 5)


def test_store_failed_load_counts_for_nothing(spark, tmp_path, target, batch):
    store = TableStore(spark, str(tmp_path))
    for policy in ("flip_if_new", "flip_matched"):
        store.write(policy, target)
        broken = batch.withColumn("v", F.when(F.col("_row_id") == "e", F.raise_error(F.lit("half-way")).cast("int")).otherwise(F.col("v")))
        for failing in (lambda p=policy: store.load(p, broken, latest=p), lambda p=policy: store.write(p, broken)):
            with pytest.raises(Exception, match="half-way"):
                failing()
            assert rows(store.read(policy)) == rows(target)
        # rows that a failed load left in the next batch are overwritten
        store._insert(f"{policy}__rows1", batch.drop("latest"), store.batch(policy) + 1)
        assert rows(store.read(policy)) == rows(target)
        assert store.load(policy, batch.filter("_row_id = 'd'"), latest=policy) == load.LoadStats(1, 3, 4)
        assert store.read(policy).count() == 4


def test_store_columns_may_change(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.write("t", spark.createDataFrame([(1, "a")], "k int, v string"))
    before = store.read("t")
    assert store.write("t", spark.createDataFrame([("x",)], "other string")).columns == ["other"]
    assert before.collect() == [(1, "a")]
    store.vacuum("t")
    assert store.read("t").collect() == [("x",)]


def test_upsert_writes_touched_groups_only(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    day = lambda n: dt.date(2023, 1, n)
    make = lambda rows: spark.createDataFrame(rows, "day date, n int")
    assert store.upsert("d", make([(day(1), 1), (day(2), 2), (day(2), 3)]), "day", ["day", "n"]) == ["2023-01-01", "2023-01-02"]
    files = {f for f in store.read("d").inputFiles() if "2023-01-01" in f}
    assert store.upsert("d", make([(day(2), 9), (day(3), 4)]), "day", ["day", "n"]) == ["2023-01-02", "2023-01-03"]
    assert sorted((r.day, r.n) for r in store.read("d").collect()) == [(day(1), 1), (day(2), 2), (day(2), 3), (day(2), 9), (day(3), 4)]
    assert {f for f in store.read("d").inputFiles() if "2023-01-01" in f} == files


@pytest.mark.parametrize("policy, order", [
    ("flip_all", None), ("flip_if_new", None), ("flip_true_only", None), ("flip_matched", None), ("max_of_batch", "day"),
    ("max_sync_minute", "synced"), ("keep", None),
])
def test_store_reads_what_the_pure_load_gives(spark, tmp_path, target, batch, policy, order):
    """Loads, a replay and a compaction, against the same steps as pure functions."""
    store = TableStore(spark, str(tmp_path))
    store.write("t", target)
    third = spark.createDataFrame([("a", dt.date(2023, 1, 1), T1, 1, None), ("f", dt.date(2023, 1, 2), T2, 6, None), (None, None, None, 0, None)], SCHEMA).drop("latest")
    want = target
    flagged = (lambda df: df.withColumn("latest", F.lit(True))) if policy == "keep" else (lambda df: df)
    for part in (batch, third):
        stats = store.load("t", flagged(part), latest=policy, order=order)
        want = load.incremental_load(flagged(part), want, latest=policy, order=order).select(target.columns)
        assert stats.after == want.count()
        assert rows(store.read("t")) == rows(want)
    again = batch.filter("v < 20")
    assert store.load("t", flagged(again), latest=policy, order=order).new == 0
    if policy in ("flip_if_new", "flip_true_only", "keep", "max_of_batch"):
        assert rows(store.read("t")) == rows(want)
    if policy == "flip_all":
        assert not any(v[1] for v in rows(store.read("t")).values())
    kept = rows(store.read("t"))
    assert rows(store.compact("t")) == kept


def test_store_load_from_nothing(spark, tmp_path, batch):
    store = TableStore(spark, str(tmp_path))
    assert store.load("t", batch.limit(0)) == load.LoadStats(0, 0, 0)
    assert store.load("t", batch) == load.LoadStats(3, 0, 3)
    assert all(v[1] for v in rows(store.read("t")).values())
    # another policy starts from a snapshot of what is there
    store.load("t", batch, latest="max_of_batch", order="day")
    assert store.read("t").count() == 3


def test_store_replace_if_changed(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    mk = lambda d: spark.createDataFrame(d, "k int, v string")
    assert store.replace_if_changed("t", mk([(1, "a")])) == (True, 1)
    assert store.replace_if_changed("t", mk([(1, "a")])) == (False, 0)
    assert store.replace_if_changed("t", mk([(1, "a"), (2, "b")])) == (True, 1)
    assert store.read("t").count() == 2


def test_refresh_in_order_stops_at_error():
    seen = []

    def bad():
        raise RuntimeError("no")

    assert refresh_in_order({"a": lambda: 1, "b": lambda: 2}) == {"a": 1, "b": 2}
    with pytest.raises(RuntimeError):
        refresh_in_order({"a": lambda: seen.append("a"), "b": bad, "c": lambda: seen.append("c")})
    assert seen == ["a"]


def test_sources(spark, tmp_path):
    (tmp_path / "drop").mkdir()
    (tmp_path / "drop" / "2023-01.csv").write_text("sku,_line\nA,1\nB,x\n")
    from pyspark.sql import types as T

    df = read_drop(spark, str(tmp_path / "drop"), T.StructType.fromDDL("sku string, _line bigint"))
    got = {r["sku"]: r for r in df.collect()}
    assert got["A"]["_file"] == "2023-01.csv" and got["B"]["_line"] is None and got["A"]["_modified"] is not None
    assert rename(df, {"_line": "n", "sku": "item"}).columns == ["n", "item"]
    out = typed(df, schema("warehouse_map"))
    assert out.columns == ["warehouse_sku", "sku_ref"] and out.count() == 2
    df.write.parquet(str(tmp_path / "p"))
    assert read_table(spark, str(tmp_path / "p"), T.StructType.fromDDL("sku string, extra int")).filter("extra is null").count() == 2


def test_all_schemas_parse(spark):
    for name in DDL:
        assert empty(spark, schema(name)).count() == 0
