"""A Spark session with the settings that the library's results rest on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "strandline", **settings: str) -> SparkSession:
    """UTC, adaptive execution with skew handling, no partitioning taken over by unions; further settings by name with ``__`` for dots."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true").config("spark.sql.unionOutputPartitioning", "false")
    for k, v in settings.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()
