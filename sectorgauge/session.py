"""Spark session with the settings the operators expect."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(app_name: str = "sectorgauge", **conf: str) -> SparkSession:
    """Session for a job; ``conf`` overrides, the cluster decides the rest."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
