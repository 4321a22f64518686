"""Training flow with a loss curve, written to a log and read back.

Spark form of the original training script: seeded exact 70/30 split (D3,
D4), z-score by training-split statistics (X1; ``fit_on="all"`` uses every row
as the original did), a classifier trained in chunks with the
training and validation loss after each chunk (M6, A4), the log appended to a
per-run folder (S4), read back (S3), missing values dropped (P6), and every
k-th validation loss printed with eight decimals (P7, X4).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.scalar import affine_array, fixed_decimals
from pulsegrid.operators.features import SCALED, array_to_features
from pulsegrid.operators.logs import every_kth_logged, logged_points
from pulsegrid.operators.models import persist_for_iterations
from pulsegrid.operators.neural import fit_with_curve, wide_log
from pulsegrid.operators.ranks import rank_split
from pulsegrid.plans.classify import embeddings_signal
from pulsegrid.operators.stats import element_stats
from pulsegrid.sources.csv import read_log_csv
from pulsegrid.sources.sinks import append_log


@dataclass
class TrainingResult:
    model: object
    curve: DataFrame          # (step, split, loss)
    log: DataFrame            # read back: (step, train_loss, val_loss)
    val_points: DataFrame     # (step, val_loss) where logged
    printed: DataFrame        # every k-th validation loss as text


def training_flow(spark: SparkSession, sf_dir: str, log_dir: str, run_id: str, seed: int,
                  hidden: Sequence[int] = (16,), chunk_iters: int = 10, chunks: int = 10,
                  fraction: float = 0.7, every: int = 10, mlp_seed: int = 7,
                  fit_on: str = "train") -> TrainingResult:
    signal = embeddings_signal(spark, sf_dir)
    split = rank_split(signal, fraction, seed, "vec_id")
    stats_rows = split if fit_on == "all" else split.filter(F.col("split") == "train")
    means, _, stds = element_stats(stats_rows, "x")
    # Constant columns become 0 for the network input; a NULL feature stays NULL.
    constant = F.array(*[F.lit(not s) for s in stds])
    z = split.select("vec_id", "label", "split", F.zip_with(
        affine_array("x", means, stds), constant,
        lambda v, c: F.when(c, F.lit(0.0)).otherwise(v)).alias("zx"))
    tagged = array_to_features(z, "zx", SCALED).select("vec_id", "label", "split", SCALED)
    tagged = persist_for_iterations(tagged)
    try:
        width = len(tagged.select(SCALED).first()[0])
        model, curve = fit_with_curve(spark, tagged, [width, *hidden, 2], chunk_iters, chunks,
                                      mlp_seed)
    finally:
        tagged.unpersist()
    append_log(wide_log(curve), log_dir, run_id=run_id, single_file=True)  # one row per chunk
    log = read_log_csv(spark, f"{log_dir.rstrip('/')}/run_id={run_id}")
    val_points = logged_points(log, "step", "val_loss")
    kth = every_kth_logged(log, "step", "val_loss", every)
    printed = kth.select("step", "pos", fixed_decimals("val_loss", "%.8f").alias("val_loss_text"))
    return TrainingResult(model, curve, log, val_points, printed)
