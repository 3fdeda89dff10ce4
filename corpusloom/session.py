"""Session settings that every entry point shares."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(name: str = "corpusloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the Parquet tables of a data folder, by a path that only Spark opens."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
