"""Interval histories against loops over days: building, late rows in any order, loads, unfolding."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from opsmart.operators import intervals as iv

DAY0 = dt.date(2024, 1, 1)
KEYS, CARRIED = ["k"], ["a", "b"]
SCHEMA = "k string, day date, a long, b long, note string"


def day(n):
    return DAY0 + dt.timedelta(n)


def some_rows(seed, n=120, keys=5, days=40):
    rnd = random.Random(seed)
    rows = {}
    for _ in range(n):
        k, d = rnd.choice("uvwxyz"[:keys]), rnd.randrange(days)
        rows[k, d] = (k, day(d), rnd.choice([None, rnd.randrange(9)]), rnd.choice([None, None, 5]), f"{k}{d}")
    return list(rows.values())


def expected(rows):
    """(key, valid_from) -> (valid_to, is_first, a, b, seen a, seen b, note)"""
    out, by_key = {}, defaultdict(list)
    for r in rows:
        by_key[r[0]].append(r)
    for k, mine in by_key.items():
        mine.sort(key=lambda r: r[1])
        last = [None, None]
        for i, r in enumerate(mine):
            last = [new if new is not None else old for new, old in zip(r[2:4], last, strict=True)]
            until = mine[i + 1][1] - dt.timedelta(1) if i + 1 < len(mine) else None
            out[k, r[1]] = (until, i == 0, *last, r[2], r[3], r[4])
    return out


def shown(df):
    rows = df.collect()
    got = {(r["k"], r["valid_from"]): (r["valid_to"], r["is_first"], r["a"], r["b"], r["seen_a"], r["seen_b"], r["note"]) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.fixture
def table(spark):
    return lambda rows: spark.createDataFrame(rows, SCHEMA)


def test_build(table):
    rows = some_rows(1)
    assert shown(iv.to_intervals(table([*rows, ("u", None, 1, 1, "x")]), KEYS, "day", CARRIED)) == expected(rows)
    assert iv.to_intervals(table([]), KEYS, "day", CARRIED).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_late_rows_in_any_order(table, spark, seed, tmp_path):
    rnd = random.Random(seed)
    rows = some_rows(seed + 10)
    rnd.shuffle(rows)
    sizes = [0, 50, 51, 60, len(rows)]
    history = iv.to_intervals(table(rows[: sizes[1]]), KEYS, "day", CARRIED)
    for i, (a, b) in enumerate(zip(sizes[1:], sizes[2:], strict=False)):
        history = iv.merge_late(history, table(rows[a:b]), KEYS, "day", CARRIED)
        history.write.parquet(f"{tmp_path}/{i}")
        history = spark.read.parquet(f"{tmp_path}/{i}")
        assert shown(history) == expected(rows[:b])


def test_late_row_replaces_its_day_and_repairs_what_was_carried(table):
    rows = [("u", day(1), 5, 1, "p"), ("u", day(3), None, 2, "q"), ("u", day(6), None, None, "r"), ("u", day(9), 7, None, "s")]
    late = [("u", day(3), None, None, "Q"), ("u", day(2), 8, None, "t"), ("v", day(4), 1, None, "n"), ("v", None, 1, 1, "no day")]
    merged = iv.merge_late(iv.to_intervals(table(rows), KEYS, "day", CARRIED), table(late), KEYS, "day", CARRIED)
    assert shown(merged) == expected([rows[0], rows[2], rows[3], *late[:3]])


def test_untouched_rows_pass_through(table):
    """Rows of other keys, and those well before the late row, are not worked out again: a wrong value in them stays."""
    history = iv.to_intervals(table([("u", day(d), d, 1, "x") for d in (0, 2, 4, 6)] + [("v", day(1), 1, 1, "x")]), KEYS, "day", CARRIED)
    marked = history.withColumn("a", F.when((F.col("day") <= str(day(2))) | (F.col("k") == "v"), -1).otherwise(F.col("a")))
    merged = shown(iv.merge_late(marked, table([("u", day(5), None, 2, "late")]), KEYS, "day", CARRIED))
    assert {k: v[2] for k, v in merged.items()} == {
        ("u", day(0)): -1, ("u", day(2)): -1, ("v", day(1)): -1, ("u", day(4)): 4, ("u", day(5)): 4, ("u", day(6)): 6,
    }


@pytest.mark.parametrize("start,end", [(0, 39), (-3, 50), (10, 20), (45, 60), (-9, -2)])
def test_unfold(table, start, end):
    rows = some_rows(3)
    history = iv.to_intervals(table(rows), KEYS, "day", CARRIED)
    lo, hi = F.lit(day(start)), F.lit(day(end))
    got = iv.unfold(history, "day", CARRIED, lo, hi, only_on_day=["note"]).collect()
    here = {(r[0], r[1]): r for r in rows}
    want = {}
    for k in {r[0] for r in rows}:
        last = [None, None]
        for n in range(min(start, 0), end + 1):
            r = here.get((k, day(n)))
            last = [new if new is not None else old for new, old in zip(r[2:4] if r else [None, None], last, strict=True)]
            if n >= start:
                want[k, day(n)] = (*last, r[4] if r else None)
    assert {(r["k"], r["date"]): (r["a"], r["b"], r["note"]) for r in got} == want and len(got) == len(want)


def test_as_of_and_load(table):
    rows = some_rows(4)
    until = F.lit(day(15))
    full = iv.to_intervals(table(rows), KEYS, "day", CARRIED)
    valid = {r["k"]: r["a"] for r in iv.as_of(full, until).collect()}
    days = iv.unfold(full, "day", CARRIED, until, until).collect()
    assert valid == {r["k"]: r["a"] for r in days if r["k"] in valid}
    early = iv.to_intervals(table([(*r[:2], -1, *r[3:]) for r in rows if r[1] <= day(15) and r[0] != "u"]), KEYS, "day", CARRIED)
    loaded = iv.unfold(iv.append_after(early, full, KEYS, until), "day", CARRIED, F.lit(day(0)), F.lit(day(39)))
    got = {(r["k"], r["date"]): r["a"] for r in loaded.collect()}
    was = {(r["k"], r["date"]): r["a"] for r in iv.unfold(full, "day", CARRIED, F.lit(day(0)), F.lit(day(39))).collect()}
    known = {r[0]: min(x[1] for x in rows if x[0] == r[0]) for r in rows}
    for (k, d), v in was.items():
        assert got[k, d] == (v if k == "u" or d > day(15) else -1 if d >= known[k] else None)
    assert len(got) == len(was)
