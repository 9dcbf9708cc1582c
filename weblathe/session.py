"""Session defaults shared by tests, bench and the command line."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_spark(app: str = "weblathe", **conf: str) -> SparkSession:
    """Return a session with UTC timestamps and adaptive execution; ``conf`` overrides the defaults."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings |= conf
    return SparkSession.builder.appName(app).config(map=settings).getOrCreate()
