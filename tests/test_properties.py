"""Property tests: split bounds, exact partition of rows by hash splits, positions."""

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pulsegrid.operators import positions as POS
from pulsegrid.operators import split as SP


@given(st.lists(st.floats(min_value=0.01, max_value=10.0), min_size=1, max_size=6))
def test_split_bounds_tile_unit_interval(weights):
    b = SP.split_bounds(weights)
    assert b[0][0] == 0.0 and b[-1][1] == 1.0
    assert all(b[i][1] == b[i + 1][0] for i in range(len(b) - 1))
    assert all(lo <= hi for lo, hi in b)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(min_value=0.05, max_value=5.0), min_size=2, max_size=4),
       st.integers(min_value=0, max_value=10_000))
def test_hash_split_is_an_exact_partition(spark, weights, seed):
    df = spark.range(0, 500).withColumnRenamed("id", "k")
    parts = SP.hash_split(df, weights, seed, "k")
    ids = [sorted(r.k for r in p.collect()) for p in parts]
    flat = sorted(x for p in ids for x in p)
    assert flat == list(range(500))


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3)), min_size=1, max_size=60),
       st.integers(min_value=0, max_value=99))
def test_positions_are_a_sorted_permutation(spark, rows, seed):
    df = spark.createDataFrame(rows, "k long, v long").repartition(3)
    out = POS.with_positions(df, POS.shuffle_order(seed, "k")).collect()
    assert sorted(r.pos for r in out) == list(range(len(rows)))
    ranked = sorted(out, key=lambda r: r.pos)
    keys = [(hashlib.md5(f"{seed}:{r.k}".encode()).hexdigest(), r.k) for r in ranked]
    assert keys == sorted(keys)
    assert sorted((r.k, r.v) for r in out) == sorted(rows)
