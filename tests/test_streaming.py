import datetime as dt

import pytest
from pyspark.sql import functions as F

from opsmart import streaming
from opsmart.functions.keys import row_id
from opsmart.operators.load import incremental_load
from opsmart.session import shared_dir
from opsmart.sources.store import TableStore

SCHEMA = "file string, line int, at timestamp, v int"


def write(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def parse(batch):
    return batch.select("v", row_id("file", "line").alias("_row_id"))


@pytest.mark.parametrize("per_trigger", [1, None])
def test_micro_batches_equal_one_batch(spark, tmp_path, per_trigger):
    src, at = str(tmp_path / "src"), dt.datetime(2023, 1, 1)
    for name, rows in {"a": [("a", 1, at, 1), ("a", 2, at, 2)], "b": [("a", 2, at, 2), ("b", 1, at, 3)], "c": [("b", 1, at, 3)]}.items():
        write(spark, src, name, rows)
    everything = spark.read.parquet(f"{src}/*")
    stream = streaming.file_stream(spark, f"{src}/*", everything.schema, files_per_trigger=per_trigger)
    store = TableStore(spark, str(tmp_path / "tables"))
    streaming.ingest_drops(stream, parse, store, "t", str(tmp_path / "cp")).awaitTermination()
    empty = parse(everything).limit(0).withColumn("latest", F.lit(True))
    want = incremental_load(parse(everything).dropDuplicates(["_row_id"]), empty)
    assert {(r.v, r._row_id) for r in store.read("t").collect()} == {(r.v, r._row_id) for r in want.collect()}
    assert store.read("t").count() == 3


def test_new_files_are_picked_up(spark, tmp_path):
    src, at = str(tmp_path / "src"), dt.datetime(2023, 1, 1)
    store = TableStore(spark, str(tmp_path / "tables"))
    schema = spark.createDataFrame([], SCHEMA).schema
    for n in (1, 2):
        write(spark, src, f"f{n}", [("f", n, at, n), ("f", 0, at, 0)])
        stream = streaming.file_stream(spark, f"{src}/*", schema)
        streaming.ingest_drops(stream, parse, store, "t", str(tmp_path / "cp")).awaitTermination()
    assert {r.v: r.latest for r in store.read("t").collect()} == {0: False, 1: False, 2: True}


def test_dedupe_and_daily(spark, tmp_path):
    src, t0 = str(tmp_path / "src"), dt.datetime(2023, 1, 1, 23)
    rows = [("e1", 1, t0, 1), ("e1", 1, t0, 1), ("e2", 1, t0 + dt.timedelta(hours=2), 5), ("e3", 1, t0 + dt.timedelta(hours=3), 7)]
    write(spark, src, "x", rows)
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = lambda: streaming.file_stream(spark, f"{src}/*", schema)
    store = TableStore(spark, str(tmp_path / "o1"))
    streaming.dedupe_into(stream(), "file", store, "once", str(tmp_path / "c1")).awaitTermination()
    assert sorted(r.file for r in store.read("once").collect()) == ["e1", "e2", "e3"]
    counts = streaming.daily_event_counts(stream(), "at", "line", "2 days", {"v": F.col("v")})
    out = streaming.run_to_days(counts, TableStore(spark, str(tmp_path / "t")), "d", str(tmp_path / "c2"), "line")
    assert {(r.date, r.event_count, r.v) for r in out.collect()} == {(dt.date(2023, 1, 1), 2, 2), (dt.date(2023, 1, 2), 2, 12)}


def test_shared_dir_follows_the_session(spark, tmp_path):
    path = shared_dir(spark, "x")
    assert "/x-" in path and path != shared_dir(spark, "x")


def test_dedupe_keeps_late_first_deliveries(spark, tmp_path):
    src, t0 = str(tmp_path / "src"), dt.datetime(2023, 1, 1)
    for k in range(5):  # the newest file first, each repeating an event of the one before
        write(spark, src, f"f{k}", [(f"e{k}", 1, t0 - dt.timedelta(days=30 * k), k), (f"e{max(0, k - 1)}", 1, t0, k), (None, 1, t0, 9)])
    store = TableStore(spark, str(tmp_path / "tables"))
    stream = streaming.file_stream(spark, f"{src}/*", spark.createDataFrame([], SCHEMA).schema, files_per_trigger=1)
    streaming.dedupe_into(stream, "file", store, "t", str(tmp_path / "cp")).awaitTermination()
    got = [r.file for r in store.read("t").collect()]
    assert sorted(x for x in got if x) == [f"e{k}" for k in range(5)] and got.count(None) == 5


def test_load_cuts_repeats_inside_a_batch(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    batch = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), (None, 2)], "_row_id string, v int")
    assert store.load("t", batch).new == 3
    assert store.load("t", batch).new == 2


def test_days_out_of_order_write_touched_days_only(spark, tmp_path):
    """Late events, weeks behind, still count; files of untouched days stay as they are."""
    src, at = str(tmp_path / "src"), lambda day, hour=0: dt.datetime(2023, 1, day, hour)
    store, schema = TableStore(spark, str(tmp_path / "t")), spark.createDataFrame([], SCHEMA).schema
    drops = [[("e", 1, at(20), 1), ("e", 2, at(20), 5), ("e", 1, at(21), 2)], [("e", 1, at(2), 3)], [("e", 1, at(20, 5), 4), ("e", 1, at(2, 9), 1)]]
    want, files = {}, {}
    for n, rows in enumerate(drops):
        write(spark, src, f"f{n}", rows)
        stream = streaming.file_stream(spark, f"{src}/*", schema)
        counts = streaming.daily_event_counts(stream, "at", "line", None, {"v": F.col("v")})
        out = streaming.run_to_days(counts, store, "d", str(tmp_path / "cp"), "line")
        for _, line, ts, v in rows:
            count, total = want.get((ts.date(), line), (0, 0))
            want[ts.date(), line] = (count + 1, total + v)
        assert {(r.date, r.line): (r.event_count, r.v) for r in out.collect()} == want
        touched = {str(r[2].date()) for r in rows}
        now = {day: {f for f in out.inputFiles() if day in f} for day in {str(d) for d, _ in want}}
        assert all(now[day] == files[day] for day in files if day not in touched)
        assert all(now[day] != files[day] for day in files if day in touched)
        files = now
