"""CSV readers (S1-S3) and sinks."""

import os

import pytest

from pulsegrid.sources.csv import read_log_csv, read_signal_csv, read_signal_csv_inferred
from pulsegrid.sources.sinks import append_log, append_report_csv, write_report
from pulsegrid.operators.features import assembler


def _write_csv(path, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_signal_csv_inferred_and_schema(spark, tmp_out):
    p = os.path.join(tmp_out, "sig")
    _write_csv(p, ["1.0,2.5,0", "3.0,4.5,1", "5.0,6.5,1"])
    a = read_signal_csv_inferred(spark, p)
    assert a.columns == ["_c0", "_c1", "label"]
    b = read_signal_csv(spark, p, n_features=2)
    assert dict(b.dtypes) == {"_c0": "double", "_c1": "double", "label": "double"}
    assert sorted(r.label for r in b.collect()) == [0.0, 1.0, 1.0]


def test_signal_csv_bad_token_fails(spark, tmp_out):
    p = os.path.join(tmp_out, "bad")
    _write_csv(p, ["1.0,abc,0"])
    with pytest.raises(Exception):
        read_signal_csv(spark, p, n_features=2).collect()


def test_null_feature_policy(spark):
    # fixture null_feature: 'error' fails the job, 'skip' drops the row
    df = spark.createDataFrame([(1.0, None, 0.0), (2.0, 3.0, 1.0)], "a double, b double, label double")
    with pytest.raises(Exception):
        assembler(["a", "b"]).transform(df).collect()
    assert assembler(["a", "b"], handle_invalid="skip").transform(df).count() == 1


def test_log_append_and_read_back(spark, tmp_out):
    p = os.path.join(tmp_out, "log")
    log = spark.createDataFrame([(0, 0.7, None), (0, None, 0.69), (1, 0.5, None)],
                                "epoch int, train_loss double, val_loss double")
    append_log(log, p, run_id="demo-0")
    append_log(log.limit(1), p, run_id="demo-0")
    back = read_log_csv(spark, os.path.join(p, "run_id=demo-0"))
    assert back.count() == 4
    assert set(back.columns) == {"epoch", "train_loss", "val_loss"}


def test_report_write_and_append(spark, tmp_out):
    rep = os.path.join(tmp_out, "report")
    lines = spark.createDataFrame([(1, "Accuracy: 50.0000%"), (0, "Total: 1.5 seconds")],
                                  "order int, line string")
    write_report(lines, rep)
    text = [r.value for r in spark.read.text(rep).collect()]
    assert text == ["Total: 1.5 seconds", "Accuracy: 50.0000%"]
    res = os.path.join(tmp_out, "results")
    append_report_csv(spark, rep, res, "run-1")
    append_report_csv(spark, rep, res, "run-2")
    got = spark.read.option("header", "true").csv(res)
    assert got.count() == 4 and {r.run_id for r in got.collect()} == {"run-1", "run-2"}


def test_scratch_paths_are_recorded(spark):
    from pulsegrid.session import scratch_path, scratch_paths

    p = scratch_path(spark, "probe")
    assert p in scratch_paths() and "probe-" in p


def test_remembered_results_follow_the_files(spark, tmp_out):
    """The inference flow is shared while the table's files stay, and runs again when they change."""
    from pulsegrid.plans import catalog
    from pulsegrid.sources.tables import table_version

    path = os.path.join(tmp_out, "embeddings.parquet")
    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    emb.write.parquet(path)
    before = table_version(spark, tmp_out, "embeddings")
    first = catalog._inference(spark, tmp_out)
    assert table_version(spark, tmp_out, "embeddings") == before
    assert catalog._inference(spark, tmp_out) is first
    old = sorted(map(tuple, catalog.q_m7_inference_validation_rows(spark, tmp_out).collect()))
    emb.where("vec_id % 3 = 0").write.mode("overwrite").parquet(path)
    assert table_version(spark, tmp_out, "embeddings") != before
    assert catalog._inference(spark, tmp_out) is not first
    new = sorted(map(tuple, catalog.q_m7_inference_validation_rows(spark, tmp_out).collect()))
    assert new != old and all(r[0] % 3 == 0 for r in new)
