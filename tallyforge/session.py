"""Session settings the library is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "tallyforge", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library's defaults; keyword dots are written as ``__``.

    ``spark.sql.shuffle.partitions`` is left to the cluster (set it to 2-3 times the cores;
    AQE coalesces what is too many) unless it is given here.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
