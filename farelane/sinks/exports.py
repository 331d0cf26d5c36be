"""CSV files and message topics."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """CSV with a header; a folder of files unless a number is given."""
    (df.coalesce(files) if files else df).write.option("header", True).mode("overwrite").csv(path)


def write_text_messages(messages: DataFrame, path: str, files: int | None = None) -> None:
    """One message per line, the stand-in for a topic."""
    shaped = messages.repartition(files) if files else messages
    shaped.select("value").write.mode("overwrite").text(path)


def write_kafka(messages: DataFrame, topic: str, servers: Iterable[str], max_bytes: int) -> None:
    """Sends the messages; the size bound must match the topic's."""
    (
        messages.select(F.col("value").cast("binary").alias("value"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", ",".join(servers))
        .option("kafka.max.request.size", str(max_bytes))
        .option("topic", topic)
        .save()
    )
