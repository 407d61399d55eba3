"""What a plan moves or gathers: checked on the plan, so that small rows show it."""

import contextlib
import io

import datetime as dt

from pyspark.sql import functions as F

from opsmart.operators import ranking


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_numbering_writes_no_column_twice(spark, monkeypatch):
    """The rows that are written and moved have their own columns and the number of their range, no copies of keys or order."""
    written = []
    stored = ranking.materialise
    monkeypatch.setattr(ranking, "materialise", lambda df, purpose: written.append(df.columns) or stored(df, purpose))
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 1, "z")], "k string, n int, v string")
    out = ranking.sequence_in_group(df, ["k"], ["n"], "pos")
    assert written == [["k", "n", "v", "_part"]]
    assert sorted((r["v"], r["pos"]) for r in out.collect()) == [("x", 2), ("y", 1), ("z", 1)]


def test_numbering_shuffles_rows_once(spark):
    """Rows are numbered where the ranges lie; afterwards only counts are shuffled, and no name stays in the catalog."""
    named = [t.name for t in spark.catalog.listTables()]
    df = spark.range(3000).selectExpr("id % 5 as k", "id", "if(id % 2 = 0, null, 'x') as v")
    out = ranking.sequence_in_group(df.repartition(4), ["k", "v"], ["id"], "pos", start=0)
    assert "hashpartitioning(_part" not in plan(out) and plan(out).count("Exchange hashpartitioning") == 1
    assert sorted(r["pos"] for r in out.collect()) == sorted(i for i in range(300) for _ in range(10))
    assert [t.name for t in spark.catalog.listTables()] == named


def test_scans_are_estimated_and_cut_by_their_rows(spark, tmp_path):
    """A session made elsewhere gets the settings of scans; what it sets itself stays."""
    from opsmart.session import SCANS, tune_scans
    from registry import Sources

    kept, factor = SCANS
    other = spark.newSession()
    for key in SCANS:
        other.conf.unset(key)
    other.conf.set(kept, "2.5")
    Sources(other, str(tmp_path))
    tune_scans(other)
    assert other.conf.get(kept) == "2.5" and other.conf.get(factor) == SCANS[factor]


def test_calendar_meets_days_not_orders(spark, tmp_path):
    from registry import Sources, load_all

    rows = [(i, dt.datetime(2000, 1, 1 + i % 3)) for i in range(40)] + [(41, None)]
    spark.createDataFrame(rows, "o_orderkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    out = load_all()["sql_spine_windows"].build(Sources(spark, str(tmp_path)))
    text = plan(out)
    assert text.count("Join") >= 3 and text.index("Join") < text.index("partial_count")  # counted below the joins
    got = {(r["kind"], str(r["date"])): r["n_orders"] for r in out.collect() if r["n_orders"]}
    assert got == {(k, f"2020-01-0{d}"): n for k in ("to_today", "historical_and_projections") for d, n in ((1, 14), (2, 13), (3, 13))}


def test_deliveries_are_several_files(spark, tmp_path, monkeypatch):
    from registry import Sources, load

    rows = [(i, dt.datetime(2024, 1, 1 + i % 10), "view", float(i)) for i in range(400)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    s = Sources(spark, str(tmp_path))
    drops = load._files_newest_first(s, str(tmp_path / "home"), copies=1)
    files = {r["f"]: (r["n"], r["newest"]) for r in spark.read.parquet(drops).groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"), F.max("ts").alias("newest")).collect()}
    assert len(files) == 5 * load._FILES and sum(n for n, _ in files.values()) == 400 and max(n for n, _ in files.values()) < 80


def test_tasks_stay_small(spark, tmp_path):
    """F7 to F9, F19, F20: what a task sorts or counts is bounded by what it reads, from files and from shuffles."""
    from opsmart.session import SETTINGS, tune_scans
    from registry import Sources

    other = spark.newSession()
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    for key in (size, "spark.sql.files.maxPartitionBytes"):
        assert SETTINGS[key] == "16m"
        other.conf.unset(key)
    Sources(other, str(tmp_path))
    assert other.conf.get(size) == other.conf.get("spark.sql.files.maxPartitionBytes") == "16m"
    other.conf.set(size, "8m")
    tune_scans(other)
    assert other.conf.get(size) == "8m"


def test_days_unfold_where_they_stay(spark, tmp_path):
    """With joins too large to broadcast, snapshots are shuffled and days are not; they unfold in all partitions of the session."""
    from registry import Sources, load_all, whole

    day = dt.datetime(1999, 1, 1)
    lines = [(i, i % 7, float(i % 50), i % 3, "FO"[i % 2], "A", day + dt.timedelta(days=i)) for i in range(90)]
    schema = "l_orderkey long, l_partkey long, l_quantity double, l_linenumber int, l_linestatus string, l_returnflag string, l_shipdate timestamp_ntz"
    spark.createDataFrame(lines, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    parts = [(i, f"part {i}", "Brand", "LARGE" if i % 2 else "PROMO", 45 + i, 1.5) for i in range(7)]
    schema = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    spark.createDataFrame(parts, schema).write.parquet(f"{tmp_path}/part.parquet")
    conf, key = spark.conf, "spark.sql.autoBroadcastJoinThreshold"
    before = conf.get(key)
    conf.set(key, "-1")
    try:
        out = load_all()["inventory_history_load"].build(Sources(spark, str(tmp_path)))
        lines = plan(out).splitlines()
        at = [(line.index("- " if "- " in line else line[:1]), line) for line in lines if "Exchange hash" in line or "Generate explode" in line]
        for k, (depth, line) in enumerate(at):
            if "Generate explode" in line:  # what it lies under: only counts of days are shuffled
                assert not [x for d, x in at[:k] if d < depth and "hashpartitioning(warehouse" in x and x.count("#") < 3]
        days = whole.QUERIES["inventory_history_all_days"](Sources(spark, str(tmp_path)))
        assert days.rdd.getNumPartitions() == int(conf.get("spark.sql.shuffle.partitions"))
        assert sum(r["n_days"] for r in out.collect()) == days.count()
    finally:
        conf.set(key, before)
