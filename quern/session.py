"""Session factory with the settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "quern", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew handling, last-wins map keys; further settings by keyword with ``_`` for ``.``."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **{k.replace("_", "."): v for k, v in conf.items()},
    }
    return b.config(map=settings).getOrCreate()
