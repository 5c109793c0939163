"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # A repeated JSON key in a payload keeps its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

CHECKPOINT_SETTING = "spark.checkpoint.dir"

def build_session(app_name: str = "jobsignals", master: str | None = None, **settings: str) -> SparkSession:
    """Create a session; ``settings`` use underscores for dots (``spark_driver_memory='8g'``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the semantic settings (UTC, ANSI, AQE) on a session somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder the cluster shares: the one ``spark.checkpoint.dir`` names, or,
    where that is unset, one beside the tables of the warehouse."""
    base = spark.conf.get(CHECKPOINT_SETTING, None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/jobsignals/{label}-{uuid.uuid4().hex}"
