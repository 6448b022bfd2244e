"""Sessions with the settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(master: str | None = None, name: str = "logharrow", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    builder = builder.master(master) if master else builder
    defaults = {
        "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic", "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
