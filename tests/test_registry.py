"""Every registered query against its counterpart SQL, on the smallest data set."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from registry import TABLES, Sources, load_all, standalone_sql  # noqa: E402
from tools.compare import table  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = load_all()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert [k for k, q in QUERIES.items() if not q.sql] == []


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, duck, key):
    df = QUERIES[key].build(Sources(spark, FOLDER))
    got = table(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(standalone_sql(QUERIES[key].sql))
    assert got == table([d[0] for d in cur.description], cur.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
