"""The trip store: files by service, source and day of drop-off.

The source names the input, such as the whole path of a file or a month. Inputs are cut by
pick-up, folders by drop-off, so two inputs meet in the days at their ends. A write replaces
all that its service and source held, also days that the input no longer has.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.scratch import scratch_folder

SOURCE_KEYS = ("service", "source")
DAY_KEY = "trip_day"
STORE_KEYS = (*SOURCE_KEYS, DAY_KEY)


def with_store_keys(trips: DataFrame, service: str | None = None, source: str | None = None) -> DataFrame:
    """Adds ``trip_day``, the date of drop-off, and ``service`` and ``source`` if given."""
    dated = trips.withColumn("trip_day", F.to_date("dropoff_datetime"))
    dated = dated.withColumn("source", F.lit(source)) if source else dated
    return dated.withColumn("service", F.lit(service)) if service else dated


# Signs that Spark writes as ``%`` and their code in the folder of a partition.
ESCAPED = re.compile(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]")


def part_folder(name: str, value: str | None) -> str:
    """The folder in which a partitioned write puts a value."""
    if value is None or value == "":
        return f"{name}=__HIVE_DEFAULT_PARTITION__"
    return f"{name}=" + ESCAPED.sub(lambda sign: f"%{ord(sign[0]):02X}", value)


def source_folder(path: str, service: str, source: str) -> str:
    """Where the store holds one source of a service."""
    if not service or not source:
        raise ValueError("service and source must not be empty")
    return "/".join([path.rstrip("/"), part_folder("service", service), part_folder("source", source)])


# The column that deals rows into parts while they wait for a write, and how many parts there are at most.
PART, PARTS = "write_part", 200


def _in_parts(df: DataFrame, keys: tuple[str, ...], files: int) -> DataFrame:
    """Rows dealt into ``files`` parts a folder, each read back by one task.

    A shuffle would bring a task its rows one by one; here they wait in scratch files, packed by
    column. The parts of a folder follow each other and never meet. Folders whose hashes are near
    share parts, as many folders must; that costs time and no file.
    """
    spark, staged, most = df.sparkSession, scratch_folder(df.sparkSession, "parts"), max(PARTS, files)
    first = F.pmod(F.xxhash64(F.lit(0), *keys), F.lit(most))
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(files))
    packed = df.withColumn(PART, (first + dealt) % most).write.partitionBy(PART)
    packed.options(**{"compression": "zstd", "parquet.writer.version": "v2"}).parquet(staged)
    found = spark.read.schema(f"{PART} LONG").parquet(staged).distinct().collect()
    parts = [spark.read.schema(df.schema).parquet(f"{staged}/{PART}={row[0]}").coalesce(1) for row in found]
    # A union lays children of one task each over each other, in one task; beside one without files it does not.
    return reduce(DataFrame.unionAll, parts, spark.read.schema(df.schema).parquet(staged, pathGlobFilter="none").drop(PART))


def shaped(df: DataFrame, keys: tuple[str, ...] = (), files: int | None = None) -> DataFrame:
    """Rows spread for writing.

    By default partitions of about equal size that hold whole keys where they
    fit; a key too large for one partition is split over several. With a fixed
    number of files each task writes one file of a folder, or of a few.
    """
    if files:
        return _in_parts(df, keys, files)
    return df.hint("rebalance", *[F.col(key) for key in keys])


def replace_source(
    df: DataFrame,
    path: str,
    service: str,
    source: str,
    below: tuple[str, ...] = (DAY_KEY,),
    files: int | None = None,
    fmt: str = "parquet",
    sort: tuple[str, ...] = (),
) -> None:
    """Makes ``df`` all that the store holds of one service and source.

    The folder of the source is overwritten as a whole, with folders by ``below`` in it, so a
    day that has gone from the input goes from the store, and an input without any row leaves
    nothing. Other sources of the same days stay. If the write fails the source is incomplete
    until it is written again.
    """
    target = source_folder(path, service, source)
    rows = shaped(df.drop(*SOURCE_KEYS), below, files)
    writer = (rows.sortWithinPartitions(*below, *sort) if sort else rows).write.format(fmt).mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "static").partitionBy(*below) if below else writer
    writer.save(target)


def write_store(
    df: DataFrame,
    path: str,
    keys: tuple[str, ...] = STORE_KEYS,
    files: int | None = None,
    fmt: str = "parquet",
    sort: tuple[str, ...] = (),
) -> None:
    """Replaces the folders that occur in ``df`` and leaves all others alone.

    For rows that are whole folders. An input that may lose days goes through
    ``replace_source``. ``sort`` orders the rows within each file, so that a filter on those
    columns skips row groups; for stores whose folders are coarser than a day.
    """
    rows = shaped(df, keys, files)
    (
        (rows.sortWithinPartitions(*keys, *sort) if sort else rows)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .save(path)
    )


def append(df: DataFrame, path: str, fmt: str = "parquet", **options: str) -> None:
    """Adds rows. Unlike the other writers it adds them again when run again."""
    df.write.format(fmt).options(**options).mode("append").save(path)


def read_day(spark: SparkSession, path: str, service: str, day: str, fmt: str = "parquet") -> DataFrame:
    """Trips stored under one service and day, with their pick-up date."""
    stored = spark.read.format(fmt).load(path)
    asked = (F.col("service") == service) & (F.col("trip_day") == F.lit(day).cast("date"))
    return stored.where(asked).withColumn("pickup_date", F.to_date("pickup_datetime"))


def read_month_to_date(spark: SparkSession, path: str, service: str, day: str, fmt: str = "parquet") -> DataFrame:
    """Trips stored from the first of the month up to the day; a missing day adds nothing."""
    stored = spark.read.format(fmt).load(path)
    last = F.lit(day).cast("date")
    asked = (F.col("service") == service) & F.col("trip_day").between(F.trunc(last, "MM").cast("date"), last)
    return stored.where(asked).withColumn("pickup_date", F.to_date("pickup_datetime"))
