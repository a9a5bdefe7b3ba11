"""Session settings that suit these jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The wide trip tables make generated methods longer than the JVM compiles; beyond this length Spark then uses
    # its split, compilable form instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def builder(app: str = "ontime") -> SparkSession.Builder:
    configured = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        configured = configured.config(key, value)
    return configured
