"""A session with the settings that the engine wants where none are given."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def session(app: str = "talkmill", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for k, v in {**DEFAULTS, **settings}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
