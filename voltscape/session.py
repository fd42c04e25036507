"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # days are computed in UTC unless an operator names another zone
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Only settable before the session starts: no call-site capture for every column expression.
STARTUP = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; `extra` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **STARTUP, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session made elsewhere (these are all runtime settings)."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
