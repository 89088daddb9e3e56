"""Session settings the detections are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    # Hour and weekday logic runs on UTC wall clocks.
    "spark.sql.session.timeZone": "UTC",
    # Runtime sizes decide broadcast joins, partition counts and skew splits; no
    # detection forces a broadcast of a table whose size it has not bounded.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "sieveline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
