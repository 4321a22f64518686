"""Hash splits, balancing and exact positions."""

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import positions as POS
from pulsegrid.operators import split as SP
from pulsegrid.operators.logs import every_kth_logged, finite
from tests.conftest import SF01


def _events(spark):
    return spark.read.parquet(f"{SF01}/events.parquet").select("event_id", "user_id", "value")


def test_split_bounds_cover_unit_interval():
    b = SP.split_bounds([0.7, 0.2, 0.1])
    assert b[0][0] == 0.0 and b[-1][1] == 1.0
    assert all(lo < hi for lo, hi in b)
    with pytest.raises(ValueError):
        SP.split_bounds([0.5, -0.1])


def test_hash_split_independent_of_layout(spark):
    ev = _events(spark)
    sides = []
    for n in (1, 2, 5):
        parts = SP.hash_split(ev.repartition(n), [0.7, 0.2, 0.1], 22, "event_id")
        sides.append([sorted(r.event_id for r in p.select("event_id").collect()) for p in parts])
    assert sides[0] == sides[1] == sides[2]
    total = sum(len(p) for p in sides[0])
    assert total == ev.count()
    assert 0.65 < len(sides[0][0]) / total < 0.75


def test_with_split_equals_hash_split(spark):
    ev = _events(spark)
    tagged = SP.with_split(ev, [0.7, 0.3], ["a", "b"], 5, "event_id")
    a = SP.hash_split(ev, [0.7, 0.3], 5, "event_id")[0]
    assert tagged.filter("split = 'a'").count() == a.count()


def test_balance_equals_filter_split_union(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", (F.col("l_returnflag") == "R").cast("double").alias("label"))
    frac = SP.balancing_fractions(li)
    assert frac[1.0] == 1.0 and 0 < frac[0.0] < 1
    fused = SP.balance(li, frac, 1000, ["l_orderkey", "l_linenumber"])
    zeros_kept = SP.hash_split(SP.label_filter(li, 0.0), [frac[0.0], 1 - frac[0.0]], 1000,
                               ["l_orderkey", "l_linenumber"])[0]
    composed = SP.union_all(SP.label_filter(li, 1.0), zeros_kept)
    assert fused.exceptAll(composed).count() == 0 and composed.exceptAll(fused).count() == 0
    counts = {r.label: r["count"] for r in fused.groupBy("label").count().collect()}
    assert abs(counts[1.0] - counts[0.0]) / counts[1.0] < 0.05


def test_exact_split_is_exact_and_matches_row_number(spark):
    ev = _events(spark)
    out = POS.exact_split(ev, 0.7, 22, "event_id").toPandas()
    n = len(out)
    assert sorted(out.pos) == list(range(n))
    assert (out.split == "train").sum() == int(n * 0.7)
    assert (out[out.split == "train"].pos.max()) < (out[out.split == "validation"].pos.min())


def test_positions_with_hot_key_and_identical_copies(spark):
    """A key holding a third of the rows, half of them identical copies."""
    rows = [(i, float(i % 17)) for i in range(3000)]
    rows += [(7, 1.0)] * 800 + [(7, float(j)) for j in range(700)]
    df = spark.createDataFrame(rows, "k long, v double").repartition(6)
    out = POS.with_positions(df, POS.shuffle_order(3, "k")).toPandas()
    assert len(out) == len(rows)
    assert sorted(out.pos) == list(range(len(rows)))
    # Brute force: positions must follow the md5 order of the key.
    import hashlib
    out["h"] = [hashlib.md5(f"3:{k}".encode()).hexdigest() for k in out.k]
    ranked = out.sort_values("pos")
    keys = list(zip(ranked.h, ranked.k))
    assert keys == sorted(keys)


def test_first_rows_and_batches(spark):
    ev = _events(spark)
    order = POS.shuffle_order(22, "event_id")
    first = POS.first_rows(ev, 5, order).select("event_id").collect()
    numbered = POS.with_positions(ev, order).filter("pos < 5").orderBy("pos")
    assert [r.event_id for r in first] == [r.event_id for r in numbered.select("event_id").collect()]
    b = POS.with_batches(ev, 32, order).groupBy("batch").count().toPandas()
    assert b["count"].max() == 32 and b["batch"].nunique() == -(-ev.count() // 32)


def test_log_filters(spark):
    # fixture nan_log: alternating NaN values
    log = spark.createDataFrame([(0, 1.0), (1, float("nan")), (2, 3.0), (3, None), (4, 5.0)],
                                "epoch long, train_loss double")
    assert [r.epoch for r in finite(log, "train_loss").collect()] == [0, 2, 4]
    kth = every_kth_logged(log, "epoch", "train_loss", 2).orderBy("pos").collect()
    assert [r.epoch for r in kth] == [0, 4]


def test_randomsplit_is_layout_dependent_but_hash_split_is_not(spark):
    ev = _events(spark).select("event_id")
    a = SP.random_split(ev.repartition(1), [0.3, 0.7], 1000)[1].count()
    b = SP.random_split(ev.repartition(5), [0.3, 0.7], 1000)[1].count()
    h = [SP.hash_split(ev.repartition(n), [0.3, 0.7], 1000, "event_id")[1].count() for n in (1, 5)]
    assert h[0] == h[1]
    assert isinstance(a, int) and isinstance(b, int)


def test_positions_do_not_depend_on_layout(spark):
    """Same rows → same positions under any input partitioning (safe to recompute)."""
    ev = _events(spark)
    order = POS.shuffle_order(7, "event_id")
    a = {r.event_id: r.pos for r in POS.with_positions(ev.repartition(1), order).collect()}
    b = {r.event_id: r.pos for r in POS.with_positions(ev.repartition(7), order).collect()}
    assert a == b


def test_positions_shuffle_join_past_broadcast_limit(spark, monkeypatch):
    monkeypatch.setattr(POS, "MAX_BROADCAST_PARTITIONS", 0)
    ev = spark.range(0, 500).withColumnRenamed("id", "event_id")
    out = POS.with_positions(ev, POS.shuffle_order(7, "event_id"))
    assert sorted(r.pos for r in out.collect()) == list(range(500))


def test_balance_keeps_unnamed_and_null_labels(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, None), (4, 2.0)], "k long, label double")
    kept = SP.balance(df, {0.0: 0.0}, 1, "k")
    assert sorted(r.k for r in kept.collect()) == [2, 3, 4]


def test_balance_sample_by_keeps_about_the_fraction(spark):
    ev = _events(spark).withColumn("label", (F.col("value") > 25).cast("double"))
    out = SP.balance_sample_by(ev, {0.0: 1.0, 1.0: 0.5}, 3)
    n0 = ev.filter("label = 0").count()
    n1 = ev.filter("label = 1").count()
    got = {r.label: r["count"] for r in out.groupBy("label").count().collect()}
    assert got[0.0] == n0
    assert 0.4 * n1 < got[1.0] < 0.6 * n1


def test_positions_survive_task_retries():
    """Every task's first attempt fails upstream of the sort; results must not change."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = os.path.join(root, "tests", "scripts", "retry_positions.py")
    out = subprocess.run([sys.executable, script, root, SF01], capture_output=True, text=True,
                         timeout=600)
    assert "SAME" in out.stdout, out.stdout[-2000:] + out.stderr[-2000:]


def hot_rows(spark, copies=False):
    """30,000 rows, a third of them on one key (one row repeated, if ``copies``)."""
    key = F.when(F.col("id") < 10_000, F.lit(-1)).otherwise(F.col("id"))
    value = F.when(F.col("id") < 10_000, F.lit(0)).otherwise(F.col("id")) if copies else F.col("id")
    return spark.range(30_000).select(key.alias("k"), value.alias("v"), (F.col("id") % 2).cast("double").alias("label"))


@pytest.mark.parametrize("copies", [False, True])
def test_rows_of_a_hot_key_are_dealt_one_by_one(spark, copies):
    df = hot_rows(spark, copies)
    if copies:
        df = SP.numbered_copies(df, "copy", block=700)
        assert df.count() == 30_000 and df.distinct().count() == 30_000
    share = {r["split"]: r["count"] / 30_000 for r in SP.with_split(df, [0.7, 0.2, 0.1], ["a", "b", "c"], 22, "k").groupBy("split").count().collect()}
    assert all(abs(share[n] - w) < 0.01 for n, w in (("a", 0.7), ("b", 0.2), ("c", 0.1)))
    parts = SP.hash_split(df.repartition(7), [0.7, 0.2, 0.1], 22, "k")
    assert [p.count() / 30_000 for p in parts] == [share[n] for n in "abc"]
    kept = SP.balance(df, {0.0: 0.5, 1.0: 1.0}, 1000, "k").groupBy("label").count()
    n = {r["label"]: r["count"] for r in kept.collect()}
    assert n[1.0] == 15_000 and abs(n[0.0] - 7_500) < 300
    group = SP.with_split(df, [0.7, 0.2, 0.1], ["a", "b", "c"], 22, "k", rows=SP.GROUP)
    assert group.where("k = -1").select("split").distinct().count() == 1
