import datetime as dt

import pytest

from opsmart.operators import quality


def test_unique_and_not_null(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "id int")
    assert tuple(quality.unique_check(df, "id").first()) == ("unique(id)", 1, False)
    assert tuple(quality.not_null_check(df, "id").first()) == ("not_null(id)", 2, False)
    good = df.filter("id = 2")
    assert quality.unique_check(good, "id").first()["passed"] and quality.not_null_check(good, "id").first()["passed"]


@pytest.mark.parametrize("hours, status", [(47, "pass"), (49, "warn"), (73, "error"), (48, "pass"), (72, "warn")])
def test_freshness(spark, hours, status):
    now = dt.datetime(2023, 5, 10, 12)
    df = spark.createDataFrame([(now - dt.timedelta(hours=hours),), (now - dt.timedelta(days=30),)], "synced timestamp")
    r = quality.freshness(df, "synced", now).first()
    assert (r["age_hours"], r["status"]) == (hours, status)


def test_freshness_of_empty_table(spark):
    assert quality.freshness(spark.createDataFrame([], "synced timestamp"), "synced", "2023-01-01").first()["status"] == "error"


def test_last_updated_round_trip(spark):
    t = lambda *ts: (spark.createDataFrame([(x,) for x in ts], "at timestamp"), "at")
    a, b = dt.datetime(2023, 1, 1), dt.datetime(2023, 2, 2, 3, 4, 5)
    listed = quality.last_updated({("s", "x"): t(a, b), ("s", "y"): t(a)})
    want = {("s", "x", b), ("s", "y", a)}
    assert {tuple(r) for r in listed.collect()} == want
    packed = quality.as_object_array(listed)
    types = {"schema_name": "string", "table_name": "string", "last_updated": "timestamp"}
    assert {tuple(r) for r in quality.flatten_objects(packed, "updates", types).collect()} == want


def test_flatten_variant(spark):
    df = spark.sql("""select parse_json('[{"a": 1, "b": "x"}, {"a": "no"}]') as v""")
    out = quality.flatten_objects(df, "v", {"a": "bigint", "b": "string"}).collect()
    assert [(r.a, r.b) for r in out] == [(1, "x"), (None, None)]
