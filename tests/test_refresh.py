"""Refreshes as graphs: levels, failures and what they hold up, stock history with late reports."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from opsmart.operators.load import LoadStats
from opsmart.plans import refresh
from opsmart.plans.refresh import Step, levels, run_graph
from opsmart.sources.store import TableStore

D = dt.date


def test_levels():
    steps = [Step("d", int, ("b", "c")), Step("b", int, ("a",)), Step("a", int, ("given",)), Step("c", int), Step("e", int, ("d",))]
    assert [sorted(s.table for s in level) for level in levels(steps)] == [["a", "c"], ["b"], ["d"], ["e"]]
    with pytest.raises(ValueError, match="each other"):
        levels([Step("a", int, ("b",)), Step("b", int, ("a",)), Step("c", int)])
    with pytest.raises(ValueError, match="same table"):
        levels([Step("a", int), Step("a", int)])
    assert levels([]) == []


def test_a_failure_holds_up_its_dependants_only():
    ran = []

    def step(name, *needs, bad=False):
        def run():
            ran.append(name)
            if bad:
                raise RuntimeError(f"no {name}\nmore")
            return LoadStats(1, 2, 3)

        return Step(name, run, needs)

    out = run_graph([step("a", bad=True), step("b", "a"), step("c", "b"), step("x"), step("y", "x"), step("z", "y", "a")])
    assert {t: o.status for t, o in out.items()} == {"a": "failed", "b": "skipped", "c": "skipped", "x": "done", "y": "done", "z": "skipped"}
    assert out["a"].reason == "no a" and out["c"].reason == "without b" and sorted(ran) == ["a", "x", "y"]
    assert (out["x"].rows, out["a"].rows) == (1, None)
    with pytest.raises(RuntimeError):
        refresh.reports(out)


def test_steps_of_a_level_run_together():
    meet = threading.Barrier(3, timeout=20)
    out = run_graph([Step(t, meet.wait) for t in "abc"], at_once=3)
    assert all(o.status == "done" for o in out.values())


def stock(spark, rows):
    schema = "sku string, sku_name string, on_hand long, on_hold long, available long, inv_run date"
    return spark.createDataFrame(rows, schema)


def test_stock_history_takes_late_reports(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.write("sku_master", spark.createDataFrame([("A", "Item A", "1", "Finished Good", "Active")], "sku string, sku_name string, upc string, sku_type string, status string"))
    other = "sku string, sku_name string, quantity_on_hand long, quantity_allocated long, quantity_available long, report_date date"
    mapping = spark.createDataFrame([("a-old", "A", False), ("x", "y", True)], "sku string, sku_ref string, match boolean")
    run = lambda: run_graph(refresh.stock_steps(store, {"warehouse_mapping": mapping}))

    def shown():
        return {(r.warehouse, r.sku, r.valid_from): (r.valid_to, r.total_on_hand, r.sku_name) for r in store.read("inventory_history").collect()}

    store.write("wms_inventory_history", stock(spark, [("A", "n", 5, 0, 5, D(2023, 1, 1)), ("a-old", "n", 2, 0, 2, D(2023, 1, 1)), ("A", "n", 9, 0, 9, D(2023, 1, 10))]))
    store.write("3pl_inventory", spark.createDataFrame([("B", "b", 1, 0, 1, D(2023, 1, 3))], other))
    out = run()
    assert out["warehouse_map"].rows == 1 and out["inventory_history"].rows == 3
    first = {
        ("Reno", "A", D(2023, 1, 1)): (D(2023, 1, 9), 7, "Item A"), ("Reno", "A", D(2023, 1, 10)): (None, 9, "Item A"),
        ("North", "B", D(2023, 1, 3)): (None, 1, "b"),
    }
    assert shown() == first
    out = run()
    assert out["warehouse_map"].rows == 0 and out["inventory_history"].report == LoadStats(0, 3, 3) and shown() == first
    store.append("wms_inventory_history", stock(spark, [("A", "n", 6, 0, 6, D(2023, 1, 4)), ("A", "n", 1, 0, 1, D(2023, 1, 10))]))
    assert run()["inventory_history"].report == LoadStats(1, 3, 4)
    assert shown() == first | {
        ("Reno", "A", D(2023, 1, 1)): (D(2023, 1, 3), 7, "Item A"), ("Reno", "A", D(2023, 1, 4)): (D(2023, 1, 9), 6, "Item A"),
        ("Reno", "A", D(2023, 1, 10)): (None, 10, "Item A"),
    }


def test_summary(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    one = spark.createDataFrame([(1,), (2,)], "k int")
    broken = one.withColumn("k", F.raise_error(F.lit("bad")).cast("int"))
    steps = lambda df: [Step("t", lambda: store.full_refresh("t", df).count()), Step("u", lambda: store.snapshot("u", store.read("t")).count(), ("t",))]
    rows = lambda df: [tuple(r) for r in refresh.summary(spark, store, run_graph(steps(df))).collect()]
    assert rows(one) == [("t", 0, "done", 2, 2), ("u", 1, "done", 2, 2)]
    assert rows(broken) == [("t", 0, "failed", None, 2), ("u", 1, "skipped", None, 2)]


def test_superseded_batches_go(spark, tmp_path):
    """after three runs a store holds one copy of a table that each of them rewrote, and all batches that count."""
    store = TableStore(spark, str(tmp_path))

    def steps(n):
        rows = spark.createDataFrame([(str(k), k, n) for k in range(n)], "_row_id string, v int, round int")
        return [
            Step("rewritten", lambda: store.write("rewritten", rows).count()),
            Step("loaded", lambda: store.load("loaded", rows, latest="flip_if_new")),
            Step("broken", lambda: 1 // (3 - n)),
        ]

    def numbers(table):
        return sorted(r["partition"] for r in spark.sql(f"SHOW PARTITIONS {store.name(table + '__rows1')}").collect())

    for n in (2, 3, 4):
        outcomes = run_graph(steps(n))
        refresh.tidy(store, outcomes)
    assert numbers("rewritten") == ["_batch=3"] and numbers("loaded") == ["_batch=1", "_batch=2", "_batch=3"]
    assert sorted(r["v"] for r in store.read("rewritten").collect()) == [0, 1, 2, 3]
    assert sorted((r["v"], r["round"], r["latest"]) for r in store.read("loaded").collect()) == [(0, 2, False), (1, 2, False), (2, 3, False), (3, 4, True)]
