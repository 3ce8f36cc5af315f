"""Session settings the engine is tuned for.

The library never changes a session it is handed; this builder is for the bench,
the tests and stand-alone runs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "saleswright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC, adaptive execution and skew handling; ANSI stays on."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
