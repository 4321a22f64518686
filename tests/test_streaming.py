"""Streaming scoring + running confusion counts equal the batch grid."""

import os

from pyspark import StorageLevel
from pyspark.sql import functions as F

from pulsegrid.operators.evaluate import metric_grid
from pulsegrid.operators.features import SCALED, array_to_features
from pulsegrid.operators.models import LOGISTIC, SVC, fit_model, score_all
from pulsegrid.plans.classify import embeddings_signal, prepare
from pulsegrid.operators.split import GROUP, with_split
from pulsegrid.streaming import running_confusion, start_running_confusion, stream_table
from tests.conftest import SF001


def test_stream_matches_batch(spark, tmp_out):
    signal = embeddings_signal(spark, SF001)
    scaled, pre = prepare(signal, "vec_id", "x")
    train = scaled.filter("split = 'train'").persist(StorageLevel.MEMORY_AND_DISK)
    models = {n: fit_model(n, train) for n in (LOGISTIC, SVC)}
    train.unpersist()

    raw = with_split(signal, (0.7, 0.2, 0.1), ("train", "test", "validation"), 22, "vec_id", rows=GROUP)
    src = os.path.join(tmp_out, "incoming")
    raw.repartition(4).write.parquet(src)

    def prep(df):
        return pre.transform(array_to_features(df, "x")).select("vec_id", "label", "split", SCALED)

    stream = stream_table(spark, src, raw.schema, max_files_per_trigger=1)
    q = start_running_confusion(running_confusion(stream, prep, models), "pg_stream_test",
                                os.path.join(tmp_out, "ckpt"))
    q.processAllAvailable()
    q.stop()
    got = {(r.model, r.split): (r.tp, r.tn, r.fp, r.fn) for r in
           spark.sql("select * from pg_stream_test").collect()}
    batch = metric_grid(score_all(prep(raw), models))
    exp = {(r.model, r.split): (r.tp, r.tn, r.fp, r.fn) for r in batch.collect()}
    assert got == exp


def test_stream_to_parquet_table(spark, tmp_out):
    from pulsegrid.plans.catalog import rule_scored_rows, signal_from_lineitem
    from pulsegrid.streaming import running_confusion_scored

    schema = spark.read.parquet(f"{SF001}/lineitem.parquet").schema
    stream = stream_table(spark, SF001, schema, table="lineitem")
    li = stream.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                       "l_discount", "l_tax", "l_returnflag")
    metrics = running_confusion_scored(rule_scored_rows(signal_from_lineitem(li)))
    out = os.path.join(tmp_out, "grid")
    q = start_running_confusion(metrics, "pg_stream_table_test", os.path.join(tmp_out, "ck"), out)
    q.processAllAvailable()
    q.stop()
    got = spark.read.parquet(out)
    assert got.count() == 12
    assert got.agg(F.sum("n")).first()[0] == 4 * spark.read.parquet(f"{SF001}/lineitem.parquet").count()
