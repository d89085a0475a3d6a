"""Session settings the jobs are written for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(cores: str = "*", name: str = "ledgermill", **extra: str) -> SparkSession:
    """Session on one machine, for tests and measurements. On a cluster the jobs use the session they are given."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = SETTINGS | {
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="ledgermill-"),  # one machine: its folder is shared
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    } | extra
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
