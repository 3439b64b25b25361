"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "tillroll", master: str | None = None, **overrides: str) -> SparkSession:
    """Session with the settings above; `overrides` are full names of settings, through `**{}`."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Folder for intermediate tables: the cluster's `spark.checkpoint.dir` where it is configured.

    Without that setting, `fallback` is used, or a temporary folder when everything runs in one local
    process. On a cluster a folder that all executors share must be configured.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    target = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not target and context.master.startswith("local"):
        target = tempfile.mkdtemp(prefix="tillroll-checkpoints-")
    if not target:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(target)
    return context.getCheckpointDir()
