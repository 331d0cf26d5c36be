"""Session settings for tests, benchmarks and stand-alone jobs.

The jobs themselves never change a session: whoever runs them owns it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: str | int = "*", app: str = "farelane", **settings: str) -> SparkSession:
    """A single-machine session in UTC without a web page."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()
