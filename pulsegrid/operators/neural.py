"""Neural classifier with a loss curve (M6, A4), re-aimed to Spark ML.

The original trains an attention network in one process.  Here a
``MultilayerPerceptronClassifier`` is fitted on Spark in chunks of
``chunk_iters`` optimizer iterations, each chunk starting from the previous
chunk's weights (``initialWeights``).  After every chunk one aggregation
computes the mean log loss of the training and validation rows together
(``groupBy(split)``), giving the ``(step, split, loss)`` curve.  The weights
vector is bounded by the layer sizes, not by the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.operators.evaluate import mean_log_loss
from pulsegrid.operators.features import SCALED
from pulsegrid.operators.models import probability_of_one

CURVE_SCHEMA = T.StructType([T.StructField("step", T.IntegerType()),
                             T.StructField("split", T.StringType()),
                             T.StructField("loss", T.DoubleType())])


def perceptron(layers: Sequence[int], max_iter: int, seed: int, features: str = SCALED,
               label: str = "label", initial_weights=None, block_size: int = 128):
    mlp = MultilayerPerceptronClassifier(featuresCol=features, labelCol=label, layers=list(layers),
                                         maxIter=max_iter, seed=seed, blockSize=block_size,
                                         predictionCol="prediction_mlp",
                                         rawPredictionCol="raw_mlp",
                                         probabilityCol="probability_mlp")
    if initial_weights is not None:
        mlp.setInitialWeights(initial_weights)
    return mlp


def split_losses(model, tagged: DataFrame, label: str = "label", split: str = "split") -> dict:
    """Mean log loss per split in one aggregation (A4 / M8)."""
    scored = model.transform(tagged).withColumn("_p1", probability_of_one("probability_mlp"))
    rows = mean_log_loss(scored, "_p1", label, by=[split]).collect()
    return {r[split]: float(r["loss"]) for r in rows}


def fit_with_curve(spark: SparkSession, tagged: DataFrame, layers: Sequence[int],
                   chunk_iters: int = 10, chunks: int = 5, seed: int = 1,
                   features: str = SCALED, label: str = "label", split: str = "split",
                   train_name: str = "train"):
    """M6: fit in chunks, recording the loss before training and after each chunk.

    ``tagged`` carries every row with its split name; the model is fitted on
    ``train_name`` rows (persist ``tagged`` beforehand).  Returns
    ``(model, curve)``; ``curve`` is ``(step, split, loss)`` with ``step`` the
    number of optimizer iterations done so far.
    """
    train = tagged.filter(F.col(split) == F.lit(train_name))
    model = perceptron(layers, 0, seed, features, label).fit(train)
    rows = [(0, s, v) for s, v in sorted(split_losses(model, tagged, label, split).items())]
    weights = model.weights
    for c in range(1, chunks + 1):
        model = perceptron(layers, chunk_iters, seed, features, label, weights).fit(train)
        weights = model.weights
        rows += [(c * chunk_iters, s, v)
                 for s, v in sorted(split_losses(model, tagged, label, split).items())]
    return model, spark.createDataFrame(rows, CURVE_SCHEMA)


MANIFEST_SCHEMA = T.StructType([T.StructField("chunk", T.IntegerType()), T.StructField("step", T.IntegerType()),
                                T.StructField("losses", T.MapType(T.StringType(), T.DoubleType())),
                                T.StructField("weights", T.ArrayType(T.DoubleType()))])


def saved_chunks(spark: SparkSession, folder: str) -> dict[int, tuple]:
    """chunk -> (step, losses, weights) of the chunks that a fit has saved so far (as many as were asked for)."""
    from pulsegrid.sources.runs import read_runs, write_run

    write_run(spark.createDataFrame([], MANIFEST_SCHEMA), folder, "start", "parquet")  # so that there is a folder to read
    rows = read_runs(spark, folder, MANIFEST_SCHEMA, "parquet").collect()
    return {r["chunk"]: (r["step"], r["losses"], r["weights"]) for r in rows}


def fit_resumable(spark: SparkSession, tagged: DataFrame, layers: Sequence[int], folder: str,
                  chunk_iters: int = 10, chunks: int = 5, seed: int = 1, features: str = SCALED,
                  label: str = "label", split: str = "split", train_name: str = "train",
                  validation_name: str = "validation"):
    """S9 + M6: ``fit_with_curve`` that saves every chunk and goes on from the last one saved.

    After each chunk its step, losses and weights are written to ``folder`` as a run
    of their own (see ``sources.runs``): a fit that lost its driver, called again with the
    same folder, reads them and starts at the next chunk, so the curve is the one an unbroken
    fit gives.  Returns (model of the step with the least validation loss, its step, curve).
    """
    from pyspark.ml.linalg import Vectors

    from pulsegrid.sources.runs import write_run

    train = tagged.filter(F.col(split) == F.lit(train_name))
    done = saved_chunks(spark, folder)
    for c in range(chunks + 1):
        if c in done:
            continue
        before = Vectors.dense(done[c - 1][2]) if c else None
        model = perceptron(layers, chunk_iters if c else 0, seed, features, label, before).fit(train)
        done[c] = (c * chunk_iters, split_losses(model, tagged, label, split), model.weights.toArray().tolist())
        row = spark.createDataFrame([(c, *done[c])], MANIFEST_SCHEMA)
        write_run(row, folder, f"chunk-{c:06d}", "parquet", single_file=True)
    rows = [(step, s, v) for c in range(chunks + 1) for step, losses in [done[c][:2]] for s, v in sorted(losses.items())]
    best = min(range(chunks + 1), key=lambda c: (done[c][1].get(validation_name, float("inf")), c))
    model = perceptron(layers, 0, seed, features, label, Vectors.dense(done[best][2])).fit(train)
    return model, done[best][0], spark.createDataFrame(rows, CURVE_SCHEMA)


def epoch_mean_loss(per_row: DataFrame, loss: str = "loss",
                    by: Sequence[str] = ("step", "split")) -> DataFrame:
    """A4: mean loss per (step, split); batch means weighted by batch size = row mean."""
    return per_row.groupBy(*by).agg(F.avg(loss).alias("loss"), F.count(F.lit(1)).alias("n"))


def wide_log(curve: DataFrame) -> DataFrame:
    """Training log shape ``(step, train_loss, val_loss)``; NULL where not logged."""
    return (curve.groupBy("step")
            .agg(F.max(F.when(F.col("split") == "train", F.col("loss"))).alias("train_loss"),
                 F.max(F.when(F.col("split") == "validation", F.col("loss"))).alias("val_loss")))
