"""A session with the settings the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution splits partitions that a hot key has made too large and
# chooses broadcast joins from sizes it has measured. Time stamps carry no zone.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
}


def build_session(
    app: str = "tablemend", master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
