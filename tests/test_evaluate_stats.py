"""Statistics, z-scores, confusion counts and rates."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import evaluate as E
from pulsegrid.operators import stats as ST
from pulsegrid.operators.columns import append_label, feature_columns, rename_last, side_by_side


def _tiny(spark):
    # fixture tiny_signal: 6 rows, 3 features + label
    rows = [(1.0, 2.0, 0.5, 1.0), (2.0, 1.0, 0.5, 0.0), (3.0, 4.0, 1.5, 1.0),
            (4.0, 3.0, 2.5, 0.0), (5.0, 6.0, 0.5, 1.0), (6.0, 5.0, 1.0, 0.0)]
    return spark.createDataFrame(rows, "_c0 double, _c1 double, _c2 double, _c3 double")


def test_rename_slice_concat(spark):
    df = rename_last(_tiny(spark))
    assert df.columns[-1] == "label"
    assert feature_columns(df) == ["_c0", "_c1", "_c2"]
    xy = df.select(append_label(F.array("_c0", "_c1", "_c2"), "label")).first()[0]
    assert xy == [1.0, 2.0, 0.5, 1.0]


def test_stats_and_zscore_match_numpy(spark):
    df = rename_last(_tiny(spark))
    cols = ["_c0", "_c1", "_c2"]
    st = ST.stats_dict(df, cols)
    data = np.array([[r[c] for c in cols] for r in df.collect()])
    for i, c in enumerate(cols):
        assert st[c][0] == pytest.approx(data[:, i].mean())
        assert st[c][1] == pytest.approx(data[:, i].std(ddof=1))
        assert st[c][2] == pytest.approx(data[:, i].std())
    z = ST.zscore_columns(df, cols, st, ddof=0).select(*cols).collect()
    expected = (data - data.mean(0)) / data.std(0)
    assert np.array(z) == pytest.approx(expected)
    shape = ST.shape(df).first()
    assert (shape.n_rows, shape.n_columns) == (6, 4)


def _scored(spark):
    rows = [(1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (0.0, 0.0), (0.0, 0.0)]
    return spark.createDataFrame(rows, "label double, prediction double").withColumn(
        "model", F.lit("m")).withColumn("split", F.lit("test"))


def test_confusion_and_rates(spark):
    g = E.metric_grid(_scored(spark)).first()
    assert (g.tp, g.tn, g.fp, g.fn, g.n) == (2, 3, 1, 1, 7)
    assert g.accuracy == pytest.approx(5 / 7 * 100)
    assert g.recall == pytest.approx(2 / 3 * 100)
    assert g.recall_compat == pytest.approx(3 / 5 * 100)
    assert g.specificity == pytest.approx(3 / 4 * 100)
    assert g.precision == pytest.approx(2 / 3 * 100)
    assert g.neg_pred_val == pytest.approx(3 / 4 * 100)


def test_all_negative_predictions_give_null(spark):
    # fixture all_negative_predictions
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (1.0, 0.0), (0.0, 0.0)],
                               "label double, prediction double")
    g = E.metric_grid(df, by=()).first()
    assert g.precision is None and g.recall == 0.0 and g.accuracy == 50.0


def test_cells_keep_zero(spark):
    df = spark.createDataFrame([(1.0, 1.0)], "label double, prediction double")
    cells = E.confusion_cells(E.confusion_counts(df, by=()), by=()).collect()
    assert sorted((c.actual, c.predicted, c.n) for c in cells) == [
        (0.0, 0.0, 0), (0.0, 1.0, 0), (1.0, 0.0, 0), (1.0, 1.0, 1)]


def test_exact_match_and_side_by_side(spark):
    df = _scored(spark).withColumn("id", F.monotonically_increasing_id())
    pairs = side_by_side(df, "id")
    assert pairs.columns == ["id", "actual", "prediction"]
    assert E.exact_match(pairs).first().all_equal is False
    same = pairs.withColumn("prediction", F.col("actual"))
    assert E.exact_match(same).first().all_equal is True


def test_mean_bce(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 0.0)], "z double, label double")
    assert E.mean_bce(df, "z").first().loss == pytest.approx(np.log(2))
    p = spark.createDataFrame([(0.5, 1.0), (0.5, 0.0)], "p double, label double")
    assert E.mean_log_loss(p, "p").first().loss == pytest.approx(np.log(2))


def test_wide_and_unpivoted_stats_agree(spark, monkeypatch):
    import pulsegrid.operators.stats as S

    df = spark.createDataFrame([(1.0, 2.0, None), (3.0, 5.0, 1.0), (4.0, 5.5, 2.0)],
                               "a double, b double, c double")
    wide = {r.feature: (r.mean, r.std_samp, r.std_pop, r.n) for r in S.column_stats(df, ["a", "b", "c"]).collect()}
    monkeypatch.setattr(S, "WIDE_AGGREGATE_LIMIT", 1)
    long = {r.feature: (r.mean, r.std_samp, r.std_pop, r.n) for r in S.column_stats(df, ["a", "b", "c"]).collect()}
    assert wide == long
    assert wide["c"][0] == 1.5 and wide["c"][3] == 3


def test_matrix_rows_layout(spark):
    g = E.confusion_counts(_scored(spark))
    rows = {r.row_label: (r.first, r.second) for r in E.matrix_rows(g).collect()}
    assert rows == {"Positive": (2, 1), "Negative": (1, 3)}
