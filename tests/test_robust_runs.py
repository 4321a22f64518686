"""Runs written once, resumed fits, layout-free forests, weighted rows, exact moments, located errors."""

import os
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from pulsegrid.operators import forest as FO
from pulsegrid.operators import models as M
from pulsegrid.operators import neural as N
from pulsegrid.operators.stats import exact_moments, zscore_columns
from pulsegrid.sources import csv as CSV
from pulsegrid.sources import runs as R


def test_a_run_written_twice_is_there_once(spark, tmp_out):
    path = os.path.join(tmp_out, "log")
    log = spark.createDataFrame([(0, 0.5), (1, None)], "step int, loss double")
    for run in ("01", "01", "1", "x/y=z"):
        R.write_run(log, path, run)
    R.write_run(log.limit(1), path, "1")
    rows = R.read_runs(spark, path, log.schema)
    assert {(r["run_id"], r["count"]) for r in rows.groupBy("run_id").count().collect()} == {("01", 2), ("1", 1), ("x/y=z", 2)}
    assert rows.columns == ["step", "loss", "run_id"]


def test_a_run_without_its_marker_is_not_visible(spark, tmp_out, monkeypatch):
    path = os.path.join(tmp_out, "log")
    log = spark.createDataFrame([(0, 0.5)], "step int, loss double")
    R.write_run(log, path, "whole", "parquet")

    def lost(*_):
        raise RuntimeError("the driver is lost")

    with monkeypatch.context() as m:
        m.setattr(R, "_marker", lost)
        with pytest.raises(RuntimeError):
            R.write_run(log, path, "broken", "parquet")
    assert [r.run_id for r in R.read_runs(spark, path, log.schema, "parquet").collect()] == ["whole"]
    R.write_run(log, path, "broken", "parquet")
    assert R.read_runs(spark, path, log.schema, "parquet").count() == 2


def test_a_task_that_fails_leaves_no_rows(spark, tmp_out):
    path = os.path.join(tmp_out, "log")
    good = spark.createDataFrame([(0,)], "step int")
    R.write_run(good, path, "a", "parquet")
    with pytest.raises(Exception):
        R.write_run(good.withColumn("step", F.raise_error(F.lit("lost")).cast("int")), path, "a", "parquet")
    assert R.read_runs(spark, path, good.schema, "parquet").count() == 1


def tagged_rows(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)], float(i % 2), "train" if i % 4 else "validation") for i in range(200)]
    df = spark.createDataFrame(rows, "k long, x array<double>, label double, split string").coalesce(1)
    return df.select("k", "label", "split", array_to_vector("x").alias("scaled_feature_vector")).persist()


def test_a_broken_fit_goes_on(spark, tmp_out, monkeypatch):
    tagged = tagged_rows(spark)
    whole = N.fit_resumable(spark, tagged, [4, 3, 2], os.path.join(tmp_out, "whole"), 3, 4, 7)
    calls = []

    def lost(model, *args):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("the driver is lost")
        return losses(model, *args)

    losses = N.split_losses
    folder = os.path.join(tmp_out, "broken")
    with monkeypatch.context() as m:
        m.setattr(N, "split_losses", lost)
        with pytest.raises(RuntimeError):
            N.fit_resumable(spark, tagged, [4, 3, 2], folder, 3, 4, 7)
    assert sorted(N.saved_chunks(spark, folder)) == [0, 1]
    again = N.fit_resumable(spark, tagged, [4, 3, 2], folder, 3, 4, 7)
    as_rows = lambda c: [(r.step, r.split) for r in c.orderBy("step", "split").collect()]
    assert as_rows(again[2]) == as_rows(whole[2])
    a, b = ([r.loss for r in c.orderBy("step", "split").collect()] for c in (again[2], whole[2]))
    assert np.allclose(a, b, atol=1e-9) and again[1] == whole[1]
    assert np.allclose(again[0].weights.toArray(), whole[0].weights.toArray(), atol=1e-6)
    tagged.unpersist()


def wide_rows(spark, n=12_500):
    """More rows than Spark takes to find split candidates, with a few distinct values in one feature."""
    x = F.array(F.sin(F.col("id") * 1.7), F.cos(F.col("id") * 0.3), (F.col("id") % 7).cast("double"), F.when(F.col("id") % 10 == 0, 1.0).otherwise(0.0))
    return spark.range(n).select("id", array_to_vector(x).alias("f"), ((F.sin(F.col("id") * 1.7) > 0.2) != (F.col("id") % 7 > 3)).cast("double").alias("label"))


def test_forest_is_the_same_under_any_layout(spark):
    df = wide_rows(spark)
    settings = M.ModelSettings(rf_num_trees=3)
    forests = [FO.fit_row_forest(df.repartition(n), "id", "f", settings=settings) for n in (1, 4, 13)]
    assert forests[0].rules() == forests[1].rules() == forests[2].rules()
    assert len(set(forests[0].rules())) == 3
    out = forests[0].transform(df)
    right = out.where("prediction_rf = label").count() / 12_500
    assert right > 0.8
    p = out.select(vector_to_array("probability_rf").alias("p")).agg(F.max(F.abs(F.col("p")[0] + F.col("p")[1] - 1))).first()[0]
    assert p < 1e-12


def test_bootstrap_weights_are_poisson(spark):
    w = spark.range(20_000).select(FO.poisson_weight(3, 0, ["id"]).alias("w"))
    got = {r.w: r["count"] / 20_000 for r in w.groupBy("w").count().collect()}
    assert abs(got[0.0] - 0.3679) < 0.015 and abs(got[1.0] - 0.3679) < 0.015 and abs(got[2.0] - 0.1839) < 0.012


def test_weighted_rows_have_the_objective_of_all_rows(spark):
    rows = [([float(i % 5), float(i % 3)], float(i % 5 > 1)) for i in range(600)] + [([0.0, 0.0], 1.0)] * 50
    df = spark.createDataFrame(rows, "x array<double>, label double").select(array_to_vector("x").alias("f"), "label")
    few = M.weighted_rows(df, "f")
    assert few.count() == 16 and few.agg(F.sum(M.ROW_WEIGHT)).first()[0] == 650
    a = M.fit_svc_weighted(df, "f", tol=1e-9)
    b = M.linear_svc("f").fit(df)
    last = [list(m.summary().objectiveHistory)[-1] for m in (a, b)]
    assert abs(last[0] - last[1]) < 0.01


def test_moments_and_z_scores_are_bit_equal_under_any_layout(spark):
    rng = random.Random(3)
    rows = [(i, rng.gauss(0, 1) * 10.0 ** rng.randint(-6, 9), 0.1 * (i % 7) if i % 11 else None, 5.0) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    cols = ["a", "b", "c"]
    moments = [exact_moments(df.repartition(n), cols) for n in (1, 5, 9)]
    assert moments[0] == moments[1] == moments[2]
    for i, c in enumerate(cols, 1):
        x = np.array([r[i] for r in rows if r[i] is not None])
        assert np.isclose(moments[0][c][0], x.mean(), rtol=1e-12)
        assert np.isclose(moments[0][c][1], x.std(ddof=1), rtol=1e-12) and np.isclose(moments[0][c][2], x.std(), rtol=1e-12)
    z = [sorted(tuple(r) for r in zscore_columns(df.repartition(n), cols, m).select("id", "a").collect()) for n, m in zip((2, 7), moments)]
    assert z[0] == z[1]
    none = exact_moments(df.where("false"), cols)
    assert none["a"] == (None, None, None)
    odd = exact_moments(spark.createDataFrame([(float("nan"), 1.0), (2.0, 1.0)], "a double, b double"), ["a", "b"])
    assert np.isnan(odd["a"][0]) and odd["b"] == (1.0, 0.0, 0.0)


def test_bad_tokens_are_named_by_file_and_line(spark, tmp_out):
    p = os.path.join(tmp_out, "sig")
    os.makedirs(p)
    with open(os.path.join(p, "a.csv"), "w") as f:
        f.write("1,2,0\n\n3,oops,1\n" + "4,5,1\n" * 20_000 + "6,7\n8,9,1,4\n")
    with open(os.path.join(p, "b.csv"), "w") as f:
        f.write("1,2,0\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = sorted((os.path.basename(r.file), r.line, r.text) for r in CSV.bad_lines(spark, p, 2).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [("a.csv", 3, "3,oops,1"), ("a.csv", 20_004, "6,7"), ("a.csv", 20_005, "8,9,1,4")]
    with pytest.raises(CSV.SignalCsvError, match="a.csv, line 3: '3,oops,1'"):
        CSV.read_signal_csv_located(spark, p, 2)
    os.remove(os.path.join(p, "a.csv"))
    assert CSV.read_signal_csv_located(spark, p, 2).count() == 1
