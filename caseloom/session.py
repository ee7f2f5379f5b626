"""A session with the settings that the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "caseloom", **conf: str) -> SparkSession:
    """UTC, adaptive plans with skew splitting. Master, memory and partition counts are the cluster's to set."""
    b = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()
