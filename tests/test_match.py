import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from opsmart.functions.similarity import similarity_score
from opsmart.operators import fuzzy, match, ranking

WORDS = "acme global supply the north pacific co ltd packaging labs beauty bottle works".split()


def random_names(seed, n):
    rnd = random.Random(seed)
    out = set()
    while len(out) < n:
        name = list(" ".join(rnd.choice(WORDS) for _ in range(rnd.randint(1, 3))))
        for _ in range(rnd.randint(0, 3)):
            i = rnd.randrange(len(name))
            name[i:i + 1] = rnd.choice(["", rnd.choice("abcxyz 1é"), name[i] * 2])
            if not name:
                name = ["a"]
        out.add("".join(name)[: rnd.choice([1, 2, 3, 4, 6, 30])])
    return sorted(out)


def brute(a, b, floor):
    return {(x, y): s for x in a for y in b if (s := similarity_score(x, y)) >= floor}


def found(spark, a, b, floor):
    mk = lambda names: spark.createDataFrame([(n,) for n in names], "name string")
    rows = fuzzy.similar_pairs(mk(a), mk(b), floor).collect()
    out = {(r[0], r[1]): r[2] for r in rows}
    assert len(out) == len(rows)  # each pair once
    return out


@pytest.mark.parametrize("floor", [81, 85, 92])
def test_pairs_equal_brute_force(spark, floor):
    a, b = random_names(1, 250), random_names(2, 250)
    assert found(spark, a, b, floor) == brute(a, b, floor)


def test_hot_keys_are_split(spark, monkeypatch):
    monkeypatch.setattr(fuzzy, "MEETINGS", 3)
    a, b = random_names(3, 80), random_names(4, 80)
    assert found(spark, a, b, 85) == brute(a, b, 85)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(*[st.lists(st.text("abc d", min_size=1, max_size=9), min_size=1, max_size=25, unique=True)] * 2)
def test_pairs_property(spark, a, b):
    assert found(spark, a, b, 85) == brute(a, b, 85)


def test_floor_limit(spark):
    with pytest.raises(ValueError):
        found(spark, ["a"], ["b"], 80)


@pytest.fixture
def vendors(spark):
    return spark.createDataFrame(
        [(1, "Acme Labs", "c1"), (2, "ACME LABS", "c2"), (3, "Acme Lab (deleted)", "c3"), (4, "North Bottle", "c4"), (5, None, "c5")],
        "id int, display_name string, check_name string",
    )


def test_best_match(spark, vendors):
    left = spark.createDataFrame([("acme labs",), ("Nrth Bottle",), ("zzz",), (None,), ("acme labs",)], "po string")
    out = {r["po"]: r for r in fuzzy.fuzzy_best_match(left, vendors, "po", "display_name", exclude="%(deleted)%").collect()}
    assert set(out) == {"acme labs", "Nrth Bottle", "zzz", None}
    assert (out["acme labs"]["id"], out["acme labs"]["similarity"]) == (1, 100)
    assert out["Nrth Bottle"]["id"] == 4 and out["zzz"]["id"] is None
    ties = fuzzy.fuzzy_best_match(left, vendors, "po", "display_name", exclude="%(deleted)%", keep_ties=True)
    assert sorted((r["id"], r["row_num"]) for r in ties.filter("po = 'acme labs'").collect()) == [(1, 1), (2, 2)]
    inner = fuzzy.fuzzy_best_match(left, vendors, "po", "display_name", keep_unmatched=False)
    assert {r["po"] for r in inner.collect()} == {"acme labs", "Nrth Bottle"}


def test_lookup_chain(spark):
    items = spark.createDataFrame([(1, "S1", "x"), (2, "U2", "x"), (3, None, "S3"), (4, "zz", "zz"), (5, "S1", "S3")], "id int, code string, name string")
    dim = spark.createDataFrame([("S1", "U1", "one"), ("S2", "U2", None), ("S3", None, "three")], "sku string, upc string, title string")
    chain = [("code", "sku"), ("code", "upc"), ("name", "sku")]
    out = {r["id"]: (r["ref"], r["title"]) for r in match.lookup_chain(items, dim, chain, {"sku": "ref", "title": "title"}).collect()}
    assert out == {1: ("S1", "one"), 2: ("S2", None), 3: ("S3", "three"), 4: (None, None), 5: ("S1", "one")}


def test_match_audit_and_coverage(spark):
    stock = spark.createDataFrame([("S1", "a", "U1"), ("S1", "a", "U1"), ("S9", "b", "U1"), ("S2", "c", None)], "sku string, sku_name string, upc string")
    dim = spark.createDataFrame([("S1", "U1", "one"), ("S2", "U2", None), ("S4", None, "four")], "sku string, upc string, sku_name string")
    audit = match.match_audit(stock, dim, ["sku", "sku_name", "upc"])
    got = {r["sku"]: (r["sku_matched"], r["ref_sku_name"], r["upc_matched"]) for r in audit.collect()}
    assert got == {"S1": (True, "one", True), "S9": (False, None, True), "S2": (True, None, False)}
    cover = match.share_matched(audit, ["sku_matched"]).first()
    assert (cover["total_rows"], cover["sku_matched_rows"]) == (3, 2)


def test_first_per_key_and_remap(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "k string, n int")
    assert {(r["k"], r["n"]) for r in match.first_per_key(df, ["k"], ["n"]).collect()} == {("a", 1), ("b", 5)}
    mapping = spark.createDataFrame([("a", "A")], "alias string, ref string")
    assert {r["k"] for r in match.remap_key(df, mapping, "k", "alias", "ref").collect()} == {"A", "b"}


def test_sequence_equals_row_number(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice(["x", "x", "x", "y", None]), rnd.choice(["p", "q", None]), i) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, a string, n int")
    got = ranking.sequence_in_group(df.repartition(5), ["k"], ["a", "n"], "pos", start=0)
    df.createOrReplaceTempView("seq_rows")
    want = spark.sql("select *, row_number() over (partition by k order by a, n) - 1 as pos from seq_rows")
    order = lambda d: sorted((str(r["k"]), r["n"], r["pos"]) for r in d.collect())
    assert order(got) == order(want)


def test_hot_key_is_numbered_over_several_partitions(spark):
    df = spark.range(20_000).withColumn("k", F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1))
    got = ranking.sequence_in_group(df, ["k"], ["id"], "pos")
    hot = got.filter("k = -1").orderBy("id").collect()
    assert [r["pos"] for r in hot] == list(range(1, len(hot) + 1))
    assert got.filter("k <> -1 and pos <> 1").count() == 0 and got.count() == 20_000
    empty = ranking.sequence_in_group(df.limit(0), ["k"], ["id"], "pos")
    assert empty.count() == 0 and empty.columns == ["id", "k", "pos"]
