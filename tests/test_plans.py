"""Inference, training and report flows."""

import os

import numpy as np
from pyspark.sql import functions as F
import pytest

from pulsegrid.operators.score import linear_predict_fn
from pulsegrid.plans.catalog import embedding_weights
from pulsegrid.plans.inference import inference_flow, standardise_all_rows
from pulsegrid.plans.classify import classification_grid, embeddings_signal
from pulsegrid.plans.report import report_lines, write_run_report
from pulsegrid.plans.training import training_flow
from pulsegrid.operators.models import ModelSettings
from tests.conftest import SF001


def test_standardise_all_rows_matches_numpy(spark):
    sig = embeddings_signal(spark, SF001)
    z = standardise_all_rows(sig).orderBy("vec_id").select("x", "z").collect()
    x = np.array([r.x for r in z])
    exp = (x - x.mean(0)) / x.std(0)
    assert np.array([r.z for r in z]) == pytest.approx(exp, abs=1e-9)


def test_inference_flow(spark):
    res = inference_flow(spark, SF001, linear_predict_fn(embedding_weights(64)), seed=22)
    pred = res.predictions.orderBy("pos").collect()
    assert len(pred) == 50
    n = 500
    assert pred[0].pos == int(n * 0.7) and pred[-1].pos == int(n * 0.7) + 49
    assert all(r.prediction == np.rint(r.probability) for r in pred)
    m = res.match.first()
    assert m.n == 50 and m.all_equal == all(r.actual == r.prediction for r in pred)
    assert res.first_rows_loss.first().loss > 0


def test_training_flow_log_roundtrip(spark, tmp_out):
    res = training_flow(spark, SF001, os.path.join(tmp_out, "logs"), "demo-0", seed=22,
                        hidden=(4,), chunk_iters=2, chunks=4, every=2)
    log = res.log.orderBy("step").collect()
    assert [r.step for r in log] == [0, 2, 4, 6, 8]
    assert all(r.train_loss is not None and r.val_loss is not None for r in log)
    printed = res.printed.orderBy("pos").collect()
    assert [r.step for r in printed] == [0, 4, 8]
    assert all(len(r.val_loss_text.split(".")[1]) == 8 for r in printed)
    assert res.val_points.count() == 5


def test_report_lines_and_files(spark, tmp_out):
    grid = classification_grid(embeddings_signal(spark, SF001), "vec_id", "x",
                               settings=ModelSettings(lr_max_iter=5, svc_max_iter=5, rf_num_trees=2))
    lines = report_lines(grid.metrics, grid.timings).orderBy("position").collect()
    assert lines[0].line.startswith("Total time of training all models:")
    assert sum("Overall Accuracy" in r.line for r in lines) == 6
    assert len({r.position for r in lines}) == len(lines)
    base = os.path.join(tmp_out, "rep")
    write_run_report(spark, grid.metrics, grid.timings, f"{base}/report", f"{base}/results",
                     f"{base}/times", "run-1")
    text = [r.value for r in spark.read.text(f"{base}/report").collect()]
    assert text == [r.line for r in lines]
    times = spark.read.option("header", "true").csv(f"{base}/times/run_id=run-1").collect()
    assert len(times) == 1 and float(times[0].seconds) > 0
    assert spark.read.option("header", "true").csv(f"{base}/results").count() == len(lines)


def test_classify_signal_csv_end_to_end(spark, tmp_out):
    from pulsegrid.operators.columns import content_key
    from pulsegrid.plans.classify import classify_signal_csv

    sig = embeddings_signal(spark, SF001)
    wide = sig.select(*[F.col("x")[i].alias(f"_c{i}") for i in range(8)], "label")
    path = os.path.join(tmp_out, "signal.csv")
    wide.write.option("header", "false").csv(path)
    res = classify_signal_csv(spark, path, 8,
                              settings=ModelSettings(lr_max_iter=5, svc_max_iter=5, rf_num_trees=2))
    rows = res.metrics.collect()
    assert len(rows) == 6 and all(r.n > 0 for r in rows)
    keyed = content_key(wide)
    a = {r.row_key for r in keyed.collect()}
    b = {r.row_key for r in content_key(wide.repartition(3)).collect()}
    assert a == b


def test_training_flow_fit_on_all_differs(spark, tmp_out):
    a = training_flow(spark, SF001, os.path.join(tmp_out, "la"), "r", seed=22, hidden=(4,),
                      chunk_iters=1, chunks=1, every=1)
    b = training_flow(spark, SF001, os.path.join(tmp_out, "lb"), "r", seed=22, hidden=(4,),
                      chunk_iters=1, chunks=1, every=1, fit_on="all")
    la = [r.val_loss for r in a.log.orderBy("step").collect()]
    lb = [r.val_loss for r in b.log.orderBy("step").collect()]
    assert len(la) == len(lb) == 2 and la != lb
