"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Adaptive execution splits skewed join partitions, coalesces small shuffle
# partitions and turns joins into broadcasts from measured sizes. The session
# zone is fixed because all times are stored as zone-less text.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    app_name: str,
    master: str | None = None,
    extra: dict[str, str] | None = None,
    hive: bool = False,
) -> SparkSession:
    """A session with the settings above; ``master`` is left to spark-submit if None.

    ``hive`` reads and writes the tables of the cluster's Hive metastore.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if hive:
        builder = builder.enableHiveSupport()
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _shared_dir(spark: SparkSession) -> str:
    return spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir() or ""


def new_scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor can reach."""
    base = _shared_dir(spark)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return f"{base.rstrip('/')}/{label}-{os.urandom(8).hex()}"


def set_local_scratch(spark: SparkSession) -> None:
    """For tests and trials: a folder of this machine, for a local master without the setting."""
    if not _shared_dir(spark) and spark.sparkContext.master.startswith("local"):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="clicktide-"))
