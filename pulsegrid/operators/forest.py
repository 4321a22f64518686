"""A random forest that does not depend on the layout of its rows (M2).

Spark's own forest draws its bootstrap per partition, and its split candidates
from a sample of the partitions, so one seed gives other trees under another
layout.  Here both follow from the rows themselves:

* a row's bootstrap weight in a tree is a Poisson(1) draw from the hash of the tree
  and the row's key, given to the fit as ``weightCol``;
* split candidates are quantiles of the rows with the smallest hashes (about
  ``CANDIDATES`` of them, a bounded sample that only names the candidates; every row
  is fitted); features become the number of the quantile they lie in, so each tree's
  candidates are the quantiles whatever Spark samples.

Impurities are sums of whole numbers, exact in any order.  The trees are Spark's,
one fit each, with ``sqrt`` features per node; a forest's probability is the mean of
its trees'.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.hashing import hash_unit
from pulsegrid.operators.models import FOREST, ModelSettings, persist_for_iterations, prediction_column, probability_column

#: Rows whose values name the split candidates.
CANDIDATES = 10_000
BINS = 32
_BINNED, _WEIGHT = "_pg_binned", "_pg_weight"


def poisson_weight(seed: int, tree: int, key: Sequence[str]) -> Column:
    """How often a row is in a tree's bootstrap: Poisson(1) from a uniform hash."""
    unit = hash_unit(seed, [F.lit(f"tree{tree}"), *key])
    total, below, out = 0.0, math.exp(-1), F.lit(0.0)
    for k in range(1, 14):
        total += below
        below /= k
        out = out + F.when(unit >= F.lit(total), F.lit(1.0)).otherwise(F.lit(0.0))
    return out


def quantile_edges(df: DataFrame, features: str, seed: int, key: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Per feature the distinct quantiles of the rows with the smallest hashes."""
    n = df.count()
    if not n:
        return []
    unit = hash_unit(seed, [F.lit("candidates"), *key])
    share = min(1.0, CANDIDATES / n)
    rows = [r[0] for r in df.where(unit < share).select(vector_to_array(features).alias("x")).collect()]
    if not rows:
        rows = [df.select(vector_to_array(features).alias("x")).orderBy("x").first()[0]]
    edges = []
    for column in zip(*rows, strict=True):
        values = sorted(column)
        cuts = {values[len(values) * i // bins] for i in range(1, bins)}
        edges.append(sorted(cuts - {values[-1]}))
    return edges


def binned(df: DataFrame, features: str, edges: Sequence[Sequence[float]]) -> DataFrame:
    """Each feature as the number of edges below it."""
    x = vector_to_array(features)
    table = F.array(*[F.array(*[F.lit(float(e)) for e in es]).cast("array<double>") for es in edges])
    numbers = F.zip_with(x, table, lambda v, es: F.size(F.filter(es, lambda e: e < v)).cast("double"))
    return df.withColumn(_BINNED, array_to_vector(numbers))


@dataclass
class RowForest:
    """The fitted trees and the split candidates; ``transform`` adds probability and prediction."""

    trees: list
    edges: list[list[float]]
    features: str
    name: str = FOREST

    def transform(self, df: DataFrame) -> DataFrame:
        out, names = binned(df, self.features, self.edges), []
        for i, tree in enumerate(self.trees):
            model = tree.copy().setFeaturesCol(_BINNED).setProbabilityCol(f"_pg_p{i}").setRawPredictionCol("").setPredictionCol("")
            out = model.transform(out)
            names.append(f"_pg_p{i}")
        one = sum((vector_to_array(p)[1] for p in names[1:]), vector_to_array(names[0])[1]) / len(names)
        return (out.withColumn(probability_column(self.name), array_to_vector(F.array(1.0 - one, one)))
                .withColumn(prediction_column(self.name), (one > 0.5).cast("double")).drop(_BINNED, *names))

    def rules(self) -> list[str]:
        """The trees as text, to compare forests."""
        return [t.trees[0].toDebugString.split("\n", 1)[1] for t in self.trees]


def fit_row_forest(df: DataFrame, key: str | Sequence[str], features: str, label: str = "label",
                   settings: ModelSettings = ModelSettings(), name: str = FOREST) -> RowForest:
    """M2: a forest of ``settings.rf_num_trees`` trees on all rows of ``df``; ``key`` names a row."""
    keys = [key] if isinstance(key, str) else list(key)
    edges = quantile_edges(df, features, settings.rf_seed, keys)
    rows = persist_for_iterations(binned(df, features, edges).select(*keys, label, _BINNED))
    try:
        trees = []
        for i in range(settings.rf_num_trees):
            one = RandomForestClassifier(featuresCol=_BINNED, labelCol=label, weightCol=_WEIGHT, numTrees=1, bootstrap=False,
                                         featureSubsetStrategy=settings.rf_subset, maxDepth=settings.rf_max_depth, maxBins=BINS,
                                         seed=settings.rf_seed + i)
            drawn = rows.withColumn(_WEIGHT, poisson_weight(settings.rf_seed, i, keys)).where(F.col(_WEIGHT) > 0)
            trees.append(one.fit(drawn))
        return RowForest(trees, edges, features, name)
    finally:
        rows.unpersist()
