"""Session factory with the settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_spark(app: str = "lattica", master: str | None = None, **conf: str) -> SparkSession:
    """Return the active session or build one; ``conf`` uses ``_`` for ``.``-free overrides."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
