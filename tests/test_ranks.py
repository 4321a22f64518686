"""Rank cuts, exact ranges and counts, and keyed permutations against brute force."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import permute as PM
from pulsegrid.operators import positions as POS
from pulsegrid.operators import ranks as RK
from tests.conftest import SF01


def events(spark):
    return spark.read.parquet(f"{SF01}/events.parquet").select("event_id", "value")


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def hot(spark):
    """A third of the rows on one key, half of those identical; keys with NULL parts that read alike."""
    rows = [(i, None, float(i % 17)) for i in range(2000)] + [(None, i, float(i)) for i in range(20)]
    rows += [(7, 7, 1.0)] * 700 + [(7, 7, float(j)) for j in range(500)] + [(None, 7, 2.0)] * 30
    return rows, spark.createDataFrame(rows, "k long, k2 long, v double").repartition(5)


def test_rank_split_equals_exact_split(spark):
    ev = events(spark)
    want = {r.event_id: r.split for r in POS.exact_split(ev, 0.7, 22, "event_id").collect()}
    for parts in (1, 6):
        got = RK.rank_split(ev.repartition(parts), 0.7, 22, "event_id")
        assert {r.event_id: r.split for r in got.collect()} == want
    text = plan_of(RK.rank_split(ev, 0.7, 22, "event_id"))
    assert "Sort" not in text and "Exchange" not in text and "positions-" not in text


@pytest.mark.parametrize("leaf", [1, 40, RK.LEAF])
@pytest.mark.parametrize("fraction", [0.0, 0.13, 0.5, 0.7, 1.0])
def test_split_of_hot_keys_and_copies_is_exact(spark, leaf, fraction, monkeypatch):
    monkeypatch.setattr(RK, "LEAF", leaf)
    monkeypatch.setattr(RK, "COPIES", 64)
    rows, df = hot(spark)
    out = [tuple(r) for r in RK.rank_split(df, fraction, 3, ["k", "k2"]).collect()]
    assert Counter(r[:3] for r in out) == Counter(rows)
    train = [r for r in out if r[3] == "train"]
    assert len(train) == int(len(rows) * fraction)
    text = lambda r: hashlib.md5(":".join(["3", *(str(x) for x in r[:2] if x is not None)]).encode()).hexdigest()
    rest = [text(r) for r in out if r[3] != "train"]
    assert not train or not rest or max(map(text, train)) <= min(rest)


@pytest.mark.parametrize("leaf", [1, RK.LEAF])
def test_row_ranges_equal_positions(spark, leaf, monkeypatch):
    monkeypatch.setattr(RK, "LEAF", leaf)
    rows, df = hot(spark)
    want = sorted(((r.pos, r.k, r.k2, r.v) for r in POS.with_positions(df, POS.shuffle_order(3, ["k", "k2"])).collect()), key=lambda r: r[0])
    for start, stop in ((0, 50), (1234, 1260), (3200, 9999), (40, 40), (9000, 9001), (-5, 3), (100, 2900)):
        got = sorted(((r.pos, r.k, r.k2, r.v) for r in RK.row_range(df, start, stop, 3, ["k", "k2"]).collect()), key=lambda r: r[0])
        assert got == want[max(start, 0): max(stop, 0)]


def test_cuts_of_few_or_no_rows(spark):
    none = spark.createDataFrame([], "k long")
    assert RK.rank_split(none, 0.7, 1, "k").count() == 0
    assert RK.row_range(none, 0, 5, 1, "k").count() == 0
    one = spark.createDataFrame([(None,)], "k long")
    assert [r.split for r in RK.rank_split(one, 0.7, 1, "k").collect()] == ["validation"]


@pytest.mark.parametrize("leaf", [1, RK.LEAF])
def test_balanced_classes_have_equal_counts(spark, leaf, monkeypatch):
    monkeypatch.setattr(RK, "LEAF", leaf)
    rows = [(i % 50, 1.0) for i in range(400)] + [(i, 0.0) for i in range(900)] + [(5, 0.0)] * 1500 + [(1, None), (2, 7.0)]
    df = spark.createDataFrame(rows, "k long, label double")
    for parts in (1, 5):
        out = RK.balance_exact(df.repartition(parts), 9, "k")
        got = Counter(r.label for r in out.collect())
        assert got == {1.0: 400, 0.0: 400, None: 1, 7.0: 1}
    first = sorted(hashlib.md5(f"9:{k}".encode()).hexdigest() for k, label in rows if label == 0.0)[:400]
    assert sorted(hashlib.md5(f"9:{r.k}".encode()).hexdigest() for r in out.where("label = 0").collect()) == first


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 10, 97, 1000, 4099, 65536, 100003])
def test_permutation_is_a_bijection(n):
    p = PM.Permutation(n, 5)
    assert p.a * p.b >= n
    some = range(n) if n < 5000 else range(0, n, 41)
    places = [p.of(x) for x in some]
    assert all(0 <= x < n for x in places) and len(set(places)) == len(places)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 11, 1000, 4099])
def test_column_equals_the_driver_side(spark, n):
    p = PM.Permutation(n, 5)
    got = spark.range(n).select("id", p.column("id").alias("p")).collect()
    assert [r.p for r in sorted(got)] == [p.of(x) for x in range(n)]
    assert sorted(r.p for r in got) == list(range(n))


def test_walks_are_long_enough(monkeypatch):
    # Sides far too large: most cells lie beyond n, and walks are long.
    monkeypatch.setattr(PM, "grid_sides", lambda n: (31, 29))
    p = PM.Permutation(50, 1)
    assert sorted(p.of(x) for x in range(50)) == list(range(50))
    assert p.walks > 3


def test_long_walks_in_the_column(spark, monkeypatch):
    monkeypatch.setattr(PM, "grid_sides", lambda n: (31, 29))
    p = PM.Permutation(50, 1)
    got = spark.range(50).select("id", p.column("id").alias("p")).collect()
    assert {r.id: r.p for r in got} == {x: p.of(x) for x in range(50)}


def test_same_order_under_two_layouts_and_epochs_differ(spark):
    ev = events(spark)
    orders = []
    for parts in (1, 7):
        rows, n = PM.numbered_rows(ev.repartition(parts), "event_id")
        orders.append({r.event_id: r.pos for r in PM.permuted(rows, n, 22).collect()})
    assert orders[0] == orders[1] and sorted(orders[0].values()) == list(range(n))
    dealt = PM.epoch_batches(rows, n, 32, range(3), 22)
    by = {}
    for r in dealt.select("event_id", "epoch", "batch", "slot").collect():
        by.setdefault(r.epoch, {})[r.event_id] = (r.batch, r.slot)
    assert len(by) == 3
    for places in by.values():
        assert sorted(places.values()) == [(i // 32, i % 32) for i in range(n)]
    assert sum(by[0][e] == by[1][e] for e in by[0]) < 10
    # Dealing epochs adds no sort and no exchange to reading the numbered rows.
    for node in ("Sort", "Exchange"):
        assert plan_of(dealt).count(node) == plan_of(rows).count(node)


def test_epochs_of_no_rows(spark):
    assert PM.epoch_batches(spark.createDataFrame([], "row long, v double"), 0, 32, [0, 1], 1).count() == 0


def test_hot_copies_are_dealt_out_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(RK, "COPIES", 500)
    df = spark.range(9000).select(F.when(F.col("id") < 3000, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    order = RK.SeededOrder(df, 2, "k")
    for rank in (10, 2500, 5000, 8999):
        out = order.sides([order.cut(rank)], ("a", "b"), "side")
        assert Counter(r.side for r in out.collect()) == {"a": rank, "b": 9000 - rank}
