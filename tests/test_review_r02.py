"""One meaning at every width and layout: array length, empty tables, undefined metrics, counts, table folders."""

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions.scalar import affine_array, dot
from pulsegrid.operators.stats import column_stats
from pulsegrid.plans import catalog
from tests.conftest import SF001


@pytest.mark.parametrize("width", [4, 40])
def test_array_length_is_checked_at_every_width(spark, width):
    ones = [1.0] * width
    df = spark.createDataFrame([(0, ones), (1, None)], "k int, x array<double>")
    rows = df.select("k", dot("x", ones).alias("d"), affine_array("x", [0.0] * width, [2.0] * width).alias("a")).orderBy("k").collect()
    assert rows[0]["d"] == width and rows[0]["a"] == [0.5] * width
    assert rows[1]["d"] is None and rows[1]["a"] is None
    for bad in (ones + [1.0], ones[:-1]):
        wrong = spark.createDataFrame([(bad,)], "x array<double>")
        for expr in (dot("x", ones), affine_array("x", ones, ones)):
            with pytest.raises(Exception, match="elements is expected"):
                wrong.select(expr.alias("v")).collect()


@pytest.mark.parametrize("width", [8, 9])
def test_statistics_of_an_empty_table(spark, width):
    cols = [f"c{i}" for i in range(width)]
    df = spark.createDataFrame([], ", ".join(f"{c} double" for c in cols))
    rows = column_stats(df, cols).collect()
    assert sorted(r["feature"] for r in rows) == cols and {r["n"] for r in rows} == {0}


def test_undefined_metrics_keep_their_line(spark):
    assert catalog.q_s8_report_lines(spark, SF001).count() == 72


def test_stream_of_a_table_folder_equals_batch(spark, tmp_path):
    src = spark.read.parquet(f"{SF001}/lineitem.parquet")
    src.repartition(3).write.parquet(str(tmp_path / "lineitem.parquet"))
    want = catalog.q_e8_metric_grid(spark, str(tmp_path)).orderBy("model", "split").collect()
    got = catalog.QUERIES["stream_e8_metric_grid"](spark, str(tmp_path)).orderBy("model", "split").collect()
    assert len(want) == 12 and got == want


def test_first_rows_loss_counts_its_rows(spark):
    from pulsegrid.operators.evaluate import mean_bce

    df = spark.range(10).select(F.lit(0.0).alias("z"), F.lit(1.0).alias("label"))
    assert mean_bce(df, "z").first()["n"] == 10
