"""Session settings that the engine's semantics rest on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply SETTINGS to a session: times in UTC, the last of repeated JSON keys, runtime re-planning."""
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    return spark
