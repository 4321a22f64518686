"""Exact split and metric grid with every first task attempt failing upstream.

Run as a subprocess (needs its own SparkContext with task retries):
prints ``SAME`` if the positions equal a run without failures.
"""

import sys

sys.path.insert(0, sys.argv[1])

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from pulsegrid.operators.positions import exact_split  # noqa: E402

spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "6").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
ev = spark.read.parquet(f"{sys.argv[2]}/events.parquet").select("event_id", "value").repartition(4)


@F.udf(T.DoubleType())
def fail_first_attempt(v):
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return v


clean = {r.event_id: (r.pos, r.split) for r in exact_split(ev, 0.7, 22, "event_id").collect()}
flaky_in = ev.withColumn("value", fail_first_attempt("value"))
flaky = {r.event_id: (r.pos, r.split) for r in exact_split(flaky_in, 0.7, 22, "event_id").collect()}
same_positions = clean == flaky and len(clean) == ev.count()

from pulsegrid.operators.evaluate import metric_grid  # noqa: E402
from pulsegrid.plans.catalog import rule_scored_rows, signal_from_lineitem  # noqa: E402

li = spark.read.parquet(f"{sys.argv[2]}/lineitem.parquet").repartition(4)


def grid(df):
    rows = metric_grid(rule_scored_rows(signal_from_lineitem(df))).collect()
    return {(r.model, r.split): (r.tp, r.tn, r.fp, r.fn, r.n) for r in rows}


same_grid = grid(li) == grid(li.withColumn("l_tax", fail_first_attempt("l_tax")))
print("SAME" if same_positions and same_grid else f"DIFFERENT {same_positions} {same_grid}")
