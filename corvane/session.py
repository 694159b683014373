"""The Spark session of the command line, the tests and the bench."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "corvane", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution. On a cluster, master and sizes come from spark-submit."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.ui.showConsoleProgress": "false"} | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
