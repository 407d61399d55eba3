import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from opsmart.operators import metrics, series

D = dt.date
RELAXED = dict(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_date_spine(spark):
    spine = series.date_spine(spark)
    assert len(spine.columns) == 17
    edge = spine.agg(F.min("date"), F.max("date"), F.count("*")).first()
    assert tuple(edge) == (D(2019, 1, 1), D(2030, 12, 31), 4383)
    r = spine.filter("date = date '2023-02-28'").first()
    assert (r.day_of_week, r.day_of_week_text, r.is_weekday, r.last_weekday_of_month) == (3, "TUE", True, D(2023, 2, 28))
    assert (r.week_first_day, r.week_last_day) == (D(2023, 2, 27), D(2023, 3, 5))
    assert (r.quarter_first_day, r.quarter_last_day, r.month_text) == (D(2023, 1, 1), D(2023, 3, 31), "FEBRUARY")
    assert (r.month_year, r.quarter_year) == ("M2 2023", "Q1 2023")
    # a month that ends on a weekend has no last weekday at all
    assert spine.filter("year = 2023 and month_number = 4 and last_weekday_of_month is not null").count() == 0
    assert spine.filter("date = date '2023-01-01'").first().week_first_day == D(2022, 12, 26)


def test_spine_windows(spark):
    spine = series.date_spine(spark)
    span = lambda kind: tuple(series.spine_window(spine, kind, "2023-05-06").agg(F.min("date"), F.max("date")).first())
    assert span("to_today") == (D(2020, 1, 1), D(2023, 5, 6))
    assert span("projections") == (D(2023, 5, 6), D(2025, 12, 31))
    assert span("historical_and_projections") == (D(2020, 1, 1), D(2025, 12, 31))


days = st.integers(-3, 12)


@settings(**RELAXED)
@given(st.dictionaries(st.tuples(st.sampled_from("ab"), days), st.one_of(st.none(), st.integers(0, 5)), min_size=1, max_size=12))
def test_fill_calendar_is_densify_join_fill(spark, cells):
    base = D(2023, 1, 1)
    rows = [(k, base + dt.timedelta(n), v) for (k, n), v in cells.items()]
    df = spark.createDataFrame(rows, "k string, day date, v int").withColumn("seen", F.col("v"))
    lo, hi = F.lit(base), F.lit(base + dt.timedelta(9))
    got = series.fill_calendar(df, ["k"], "day", ["v"], lo, hi, only_on_day=["seen"])
    dense = series.densify(df.select("k").distinct(), lo, hi).join(df.withColumnRenamed("day", "date"), ["k", "date"], "left")
    want = series.forward_fill(dense, ["k"], "date", ["v"])
    key = lambda d: sorted((r.k, r.date, str(r.v), str(r.seen)) for r in d.collect())
    assert key(got) == key(want)


def test_fill_calendar_keeps_repeated_days(spark):
    day = lambda n: D(2023, 1, n)
    twice = [("a", day(2), 5), ("a", day(2), 5), ("a", day(4), 7), ("b", day(9), 1), ("b", day(9), 1)]
    df = spark.createDataFrame(twice, "k string, day date, v int")
    got = series.fill_calendar(df, ["k"], "day", ["v"], F.lit(day(1)), F.lit(day(4)))
    want = [("a", day(1), None), ("a", day(2), 5), ("a", day(2), 5), ("a", day(3), 5), ("a", day(4), 7), *[("b", day(n), None) for n in range(1, 5)]]
    assert sorted(tuple(r) for r in got.select("k", "date", "v").collect()) == want


@settings(**RELAXED)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=15))
def test_weighted_age_is_the_triangular_sum(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "m int, v int")
    got = {r.m: r.w for r in series.weighted_age(df, ["m"], "v", "w", "c").collect()}
    assert got == {a: sum(values[b] * (a - b + 1) for b in range(a + 1)) for a in range(len(values))}


@settings(**RELAXED)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 20)), st.integers(0, 3)), min_size=1, max_size=12))
def test_rolling_ratio_is_a_row_loop(spark, pairs):
    df = spark.createDataFrame([("s", i, a, b) for i, (a, b) in enumerate(pairs)], "k string, d int, a int, b int")
    out = series.rolling_ratios(df, ["k"], "d", 3, {"a": F.col("a"), "b": F.col("b")}, {"r": ("a", "b", 4)})
    for r in out.collect():
        part = pairs[max(0, r.d - 2): r.d + 1]
        known = [a for a, _ in part if a is not None]
        top, bottom = sum(known), sum(b for _, b in part)
        assert r.r == (None if bottom == 0 or not known else float(f"{top / bottom + 1e-9:.4f}"))


def test_running_by_day_counts_peers(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 1, 3), ("a", 2, 4)], "k string, d int, v int")
    got = {(r.d, r.s) for r in series.running_by_day(df, ["k"], "d", {"s": F.col("v")}).collect()}
    assert got == {(1, 5), (2, 9)}


def test_event_columns_and_matrix(spark):
    ev = spark.createDataFrame([("d1", "view", 3), ("d1", "click", 1), ("d2", "other", 9)], "date string, event_name string, n int")
    out = metrics.event_columns(ev, {"views": ("view", "n"), "clicks": ("click", "n")}).collect()
    assert [(r.date, r.views, r.clicks) for r in out] == [("d1", 3, 1)]
    parts = spark.createDataFrame([("s", "CAP"), ("s", "JAR"), ("t", "CAP")], "sku string, kind string")
    m = {r.sku: (r.cap, r.jar) for r in metrics.presence_matrix(parts, ["sku"], "kind", {"cap": "CAP", "jar": "JAR"}).collect()}
    assert m == {"s": (True, True), "t": (True, None)}


def test_conditional_aggregates(spark):
    df = spark.createDataFrame([(1, 10), (None, 20), (3, 30)], "c int, v int")
    r = df.agg(metrics.sum_if(F.col("c") > 2, F.col("v")).alias("s"), metrics.count_if(F.col("c") > 0).alias("n")).first()
    assert (r.s, r.n) == (30, 2)
