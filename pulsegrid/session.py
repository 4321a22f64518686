"""Session helpers: a local session for tests/bench and a shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app: str = "pulsegrid") -> SparkSession:
    """Session for tests and the local bench. On a cluster, build your own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when nothing is set (tests, local runs) a
    folder under the system temp dir is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current:
            sc.setCheckpointDir(current)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="pulsegrid-ckpt-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current


_CREATED: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the checkpoint folder for written tables.

    Results that read from such a table (positions, CSV copies) read it
    lazily, so nothing here deletes them; ``scratch_paths`` lists what this
    process created, for the job to remove once its outputs are written (or
    leave to a retention rule on the checkpoint folder).
    """
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    _CREATED.append(path)
    return path


def scratch_paths() -> list[str]:
    """Scratch folders created by this process, oldest first."""
    return list(_CREATED)
