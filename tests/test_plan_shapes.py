"""Plans keep the shape that scales: no nested loops, pruned scans, early cuts."""

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

from opsmart.operators import load, match
from opsmart.operators.series import fill_calendar
from registry import Sources, load_all

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

CHECKED = [
    "shop_metrics_30d", "interest", "retention_final", "ads_modified", "inventory_history", "txn_register", "bom_enrich", "po_tracker",
    "average_price", "cumulative_purchases", "item_ref_mapping", "match_audit", "fuzzy_with_ties", "load_flip_matched",
    "load_max_of_batch", "scalar_attach", "warehouse_sku_match", "d2c_sales",
]


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("key", CHECKED)
def test_no_nested_loops(no_broadcast, key):
    text = plan(load_all()[key].build(Sources(no_broadcast, FOLDER)))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in text


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(match.current_records(spark.read.parquet(f"{FOLDER}/part.parquet").withColumn("is_most_recent_record", F.col("p_size") > 10)).select("p_name"))
    assert "GreaterThan(p_size,10)" in text and "struct<p_name:string,p_size:int>" in text


def test_first_row_is_cut_before_the_shuffle(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    text = plan(match.first_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]))
    assert text.count("WindowGroupLimit") >= 2


def test_calendar_fill_shuffles_snapshots_only(no_broadcast):
    orders = no_broadcast.read.parquet(f"{FOLDER}/orders.parquet")
    daily = orders.groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("day")).agg(F.count("*").alias("n"))
    lo, hi = F.lit("1996-01-01").cast("date"), F.lit("1996-12-31").cast("date")
    text = plan(fill_calendar(daily, ["o_custkey"], "day", ["n"], lo, hi))
    tree = text.split("\n\n")[0]
    assert "Join" not in tree and tree.count("Exchange") == 2  # the daily sums, then the window


def test_daily_load_shuffles_no_days(no_broadcast):
    from registry import whole

    tree = plan(whole.QUERIES["inventory_history_load_all_days"](Sources(no_broadcast, FOLDER)))
    moved = [line for line in tree.splitlines() if line.startswith("Arguments: hashpartitioning(")]
    assert moved and not any("_row_id" in line or "date#" in line.replace("inv_date#", "") for line in moved)


def test_small_batch_leaves_a_big_target_unshuffled(spark):
    target = spark.read.parquet(f"{FOLDER}/lineitem.parquet").select(F.col("l_orderkey").cast("string").alias("_row_id"))
    batch = spark.read.parquet(f"{FOLDER}/supplier.parquet").select(F.col("s_suppkey").cast("string").alias("_row_id"), "s_name")
    tree = plan(load.new_rows(batch, target)).split("\n\n")[0]
    assert "SortMergeJoin" not in tree and tree.count("BroadcastExchange") == tree.count("Exchange")
