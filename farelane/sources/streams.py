"""Streams of messages with a ``value`` column."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def kafka_options(topic: str, servers: Iterable[str], max_offsets: int | None = None) -> dict[str, str]:
    """Reader options: one topic from the beginning, lost offsets are not an error."""
    options = {
        "kafka.bootstrap.servers": ",".join(servers),
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    return options | ({"maxOffsetsPerTrigger": str(max_offsets)} if max_offsets else {})


def kafka_messages(spark: SparkSession, topic: str, servers: Iterable[str], max_offsets: int | None = None) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(topic, servers, max_offsets)).load()


def text_messages(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """One message per line; stands in for a topic and paces a replay by files."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def table_stream(
    spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)
