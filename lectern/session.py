"""The Spark session of the command line."""

from __future__ import annotations

from pyspark.sql import SparkSession

from lectern.sources.sqlite import PUSHDOWN


def session(name: str = "lectern", **conf: str) -> SparkSession:
    """UTC, ANSI, adaptive execution, filters for Python sources; the number of shuffle partitions is left to the cluster."""
    builder = SparkSession.builder.appName(name)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", PUSHDOWN: "true"} | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
