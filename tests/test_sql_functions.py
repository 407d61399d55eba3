"""SQL functions against the Column functions and plans they stand for."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from opsmart.functions import dates, numbers, sku, sql
from opsmart.functions.keys import file_line_id
from opsmart.operators import series
from opsmart.plans import feeds


@pytest.fixture(scope="module")
def session(spark):
    sql.register(spark)
    return spark


def _texts(pieces, n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 6))) for _ in range(n)] + [None, ""]


SKUS = _texts(["SKU#:", "A12-34", "/", "-DELETE", ".", " ", "AB1", "MISC SUPPLY", "SKU#:"], 400, 1)
NUMBERS = _texts(["$", ",", "1", "2.5", "-", " ", "x", "1,000", "(", "e"], 400, 2)
DAYS = _texts(["1", "12", "/", "31", "2023", "23", " ", "02/30/2023", "03/31/2023 11:59:00 PM", "x"], 400, 3) + ["2/29/24", "02/29/2023"]

PAIRS = [
    ("clean_sku_current", SKUS, sku.clean_sku_current),
    ("clean_sku_line", SKUS, sku.clean_sku_line),
    ("sku_upc", SKUS, sku.upc_current),
    ("sku_location", SKUS, sku.location_current),
    ("is_misc_supply", SKUS, sku.is_misc_supply),
    ("parse_amount", NUMBERS, numbers.parse_amount),
    ("parse_count", NUMBERS, numbers.parse_count),
    ("parse_us_timestamp", DAYS, dates.parse_us_timestamp),
    ("parse_slash_date", DAYS, dates.parse_slash_date),
]


@pytest.mark.parametrize("name,texts,column", PAIRS, ids=[p[0] for p in PAIRS])
def test_scalars(session, name, texts, column):
    df = session.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", F.expr(f"{name}(t)").alias("sql"), column(F.col("t")).alias("own")).collect()
    assert [r for r in rows if r["sql"] != r["own"]] == []
    assert any(r["own"] is not None for r in rows)


def test_calendar(session):
    got = session.sql("select * from date_spine(date'2019-12-20', date'2024-03-05')")
    own = series.date_spine(session, "2019-12-20", "2024-03-05")
    assert got.schema.simpleString() == own.schema.simpleString()
    assert got.exceptAll(own).count() == 0 == own.exceptAll(got).count()


@pytest.mark.parametrize("kind", ["to_today", "projections", "historical_and_projections"])
def test_windows(session, kind):
    got = {r[0] for r in session.sql(f"select date from spine_{kind}(date'2023-05-06')").collect()}
    own = series.spine_window(series.date_spine(session), kind, "2023-05-06")
    assert got == {r["date"] for r in own.collect()} and min(got) >= dt.date(2020, 1, 1)


def test_parser_is_a_projection(session, tmp_path):
    cols = [c.split() for c in sql.WMS_COLUMNS.split(", ")]
    extra = ["textbox_15", "textbox_18", "textbox_42", "textbox_28", "_modified", "_fivetran_synced"]
    rnd = random.Random(4)
    rows = []
    for i in range(200):
        row = {n: rnd.choice(["7", "1,000.25", None, "x"]) for n, _ in cols} | {n: "x" for n in extra}
        row |= {"sku": rnd.choice(SKUS), "end_date": "03/31/2023 11:59:00 PM" if i % 2 else "junk", "_file": "a.csv", "_line": i}
        rows.append(tuple(row.values()))
    schema = ", ".join(f"{n} {t}" for n, t in cols) + ", " + ", ".join(f"{n} string" for n in extra)
    session.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/report")
    report = session.read.parquet(f"{tmp_path}/report")
    arguments = ", ".join(f"r.{n}" for n, _ in cols)
    got = session.sql(f"select p.* from {{report}} r, lateral parse_wms_inventory({arguments}) p where r.customer is not null", report=report)
    own = feeds.parse_inventory(report).select(*[n for n, _, _ in sql.WMS_ROW])
    assert got.exceptAll(own).count() == 0 == own.exceptAll(got).count() and got.count() > 100
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Join", "Exchange", "Python", "Arrow", "Generate"))


def test_row_id(session):
    df = session.createDataFrame([("a.csv", 1), (None, 2), ("b", None)], "_file string, _line long")
    assert all(r[0] == r[1] for r in df.select(F.expr("file_line_id(_file, _line)"), file_line_id()).collect())
