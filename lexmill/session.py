"""Session factory with the settings that the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "lexmill", master: str | None = None, **conf: str) -> SparkSession:
    """AQE on, UTC, Arrow on; partition counts are left to AQE and the cluster unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
