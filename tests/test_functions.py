"""Scalar expressions: hashing, z-score, sigmoid, rint, loss, ratios, formatting."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from pulsegrid.functions import (bce_with_logits, dot, fixed_decimals, hash_unit, percent_of,
                                 rint, sigmoid, zscore)


def test_hash_unit_matches_duckdb(spark):
    df = spark.range(0, 50).withColumnRenamed("id", "k")
    got = {r.k: r.u for r in df.select("k", hash_unit(22, "k").alias("u")).collect()}
    exp = dict(duckdb.sql(
        "SELECT k, CAST('0x' || substr(md5('22:' || k), 1, 8) AS BIGINT) / 4294967296.0 AS u "
        "FROM range(50) t(k)").fetchall())
    assert got == pytest.approx(exp, abs=0, rel=0)
    assert all(0 <= v < 1 for v in got.values())


def test_half_even_rounding(spark):
    # fixture half_probabilities
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "p double")
    assert [r[0] for r in df.select(rint("p")).collect()] == [0.0, 2.0, 2.0]


def test_extreme_logits_finite(spark):
    # fixture extreme_logits: BCE stays finite at |z| = 800
    df = spark.createDataFrame([(800.0, 0.0), (-800.0, 0.0), (0.0, 1.0)], "z double, y double")
    vals = [r[0] for r in df.select(bce_with_logits("z", "y")).collect()]
    assert vals[0] == pytest.approx(800.0)
    assert vals[1] == pytest.approx(0.0, abs=1e-300)
    assert vals[2] == pytest.approx(math.log(2))


def test_sigmoid_matches_formula(spark):
    df = spark.createDataFrame([(-3.0,), (0.0,), (2.0,)], "z double")
    got = [r[0] for r in df.select(sigmoid("z")).collect()]
    assert got == pytest.approx([1 / (1 + math.exp(3)), 0.5, 1 / (1 + math.exp(-2))])


def test_zscore_constant_column_is_null(spark):
    # fixture constant_column: NumPy gives NaN, we give NULL (StandardScaler gives 0.0)
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [r[0] for r in df.select(zscore("x", 3.0, 0.0)).collect()] == [None, None]


def test_percent_of_zero_denominator(spark):
    df = spark.createDataFrame([(1, 4), (0, 0)], "a long, b long")
    assert [r[0] for r in df.select(percent_of("a", "b")).collect()] == [25.0, None]


def test_dot_and_format(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], 0.123456789)], "x array<double>, v double")
    row = df.select(dot("x", [0.5, -1.0, 2.0], 0.25).alias("d"),
                    fixed_decimals("v").alias("t"),
                    fixed_decimals(F.col("v") * 100, "%2.4f%%").alias("p")).first()
    assert row.d == pytest.approx(0.5 - 2.0 + 6.0 + 0.25)
    assert row.t == "0.12345679"
    assert row.p == "12.3457%"


def test_wide_arrays_use_the_same_arithmetic(spark, monkeypatch):
    import pulsegrid.functions.scalar as S

    w = [0.1 * (i % 5 - 2) for i in range(10)]
    m = [float(i) for i in range(10)]
    sd = [1.0 + i for i in range(9)] + [0.0]
    df = spark.createDataFrame([([float(i * i) for i in range(10)],)], "x array<double>")
    narrow = df.select(S.dot("x", w, 0.5).alias("d"), S.affine_array("x", m, sd).alias("z")).first()
    monkeypatch.setattr(S, "UNROLL_LIMIT", 3)
    wide = df.select(S.dot("x", w, 0.5).alias("d"), S.affine_array("x", m, sd).alias("z")).first()
    assert wide.d == narrow.d
    assert wide.z == narrow.z and wide.z[-1] is None


def test_oracle_rounds_never_give_negative_zero():
    import duckdb

    from pulsegrid.plans.catalog import positive_zero_rounds

    sql = positive_zero_rounds("SELECT round(-0.00000001::DOUBLE, 6) AS a, round(round(-1e-9, 3), 6) AS b, "
                               "round_even(0.4, 0) AS c")
    a, b, c = duckdb.sql(sql).fetchall()[0]
    assert str(a) == "0.0" and str(b) == "0.0" and float(c) == 0.0
