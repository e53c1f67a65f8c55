"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that change results or keep hot groups from landing in one task.
# Sizing (shuffle partitions, executor memory) is left to the cluster and to AQE.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A task that writes few partitions keeps their files open instead of sorting its rows first, which may spill.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
    # Merge sessions inside each map task, so that a hot key shuffles few rows.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "meterline", master: str | None = None, **settings: str) -> SparkSession:
    """A configured session; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    # Stack traces of every column call cost more than building the plan.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    return configure(builder.config("spark.ui.enabled", "false").getOrCreate())
