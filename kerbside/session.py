"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

REQUIRED = {
    # Zoneless source columns are labelled as UTC instants, whatever the host's zone.
    "spark.sql.session.timeZone": "UTC",
    # Joins choose broadcast or shuffle from measured sizes and split skewed partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required runtime settings to an existing session."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "kerbside", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())
