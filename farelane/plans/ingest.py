"""Jobs that move trips between zones of the lake."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.plans.cleaning import clean_trips
from farelane.plans.daily import daily_kpis_on, zone_kpis_on
from farelane.sinks.store import DAY_KEY, append, read_month_to_date, replace_source, source_folder, with_store_keys, write_store
from farelane.sinks.tables import daily_table_names, publish
from farelane.sources.files import read_month_files


def ingest_raw(
    spark: SparkSession,
    patterns: list[str],
    target: str,
    service: str,
    dropoff: str,
    source: str | None = None,
    below: tuple[str, ...] = (DAY_KEY,),
    at_once: int = 4,
) -> list[str]:
    """Files that match the patterns into the raw store, by day of drop-off; gives back the sources written.

    Each file is a source of its own, named by its whole path, or all are ``source`` if given.
    Ingesting a file again replaces all its rows and no others, also in days that it shares
    with other files or no longer has. Files that vanish are skipped. Each source is a job of
    its own, of which some run ``at_once``.
    """
    reader = spark.read.option("ignoreMissingFiles", "true")
    every = reader.parquet(*patterns)
    if source:
        inputs = {source: every}
    else:
        found = spark.read.format("binaryFile").load(patterns).select("path").orderBy("path").collect()
        inputs = {row["path"]: reader.schema(every.schema).parquet(row["path"]) for row in found}

    def write(name: str) -> None:
        replace_source(inputs[name].withColumn(DAY_KEY, F.to_date(dropoff)), target, service, name, below)

    with ThreadPoolExecutor(at_once) as jobs:
        list(jobs.map(inheritable_thread_target(spark)(write), inputs))
    return list(inputs)


def stored_rows(spark: SparkSession, target: str, service: str, source: str) -> int:
    """Rows that the store holds of one source; no column is read, so the files' footers tell."""
    folder = source_folder(target, service, source)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folder)
    return 0 if files.select("path").isEmpty() else spark.read.parquet(folder).count()


def raw_to_processed(
    raw: DataFrame,
    zones: DataFrame,
    service: str,
    target: str,
    source: str,
    null_policy: str = "strict",
    below: tuple[str, ...] = (DAY_KEY,),
    files: int | None = None,
) -> dict[str, int]:
    """Cleans one service into the processed store and tells the rows before and after.

    ``source`` names the input, such as its month: a later run replaces all rows of the
    same source and leaves those of others in the days that both touch. Rows after are
    counted from the files that the write left, so tasks that ran twice do not count twice.
    """
    cleaned = clean_trips(raw, zones, service, null_policy)
    replace_source(with_store_keys(cleaned), target, service, source, below, files)
    return {"before": raw.count(), "after": stored_rows(raw.sparkSession, target, service, source)}


def clean_month_files(
    spark: SparkSession, root: str, zones: DataFrame, service: str, target: str, null_policy: str = "strict"
) -> None:
    """All monthly files of a service through the cleaning, into folders by service, year and month."""
    raw = read_month_files(spark, root, service)
    write_store(clean_trips(raw, zones, service, null_policy), target, ("service", "year", "month"))


def convert_table(source: DataFrame, target: str, fmt: str = "parquet", **options: str) -> None:
    """Appends a table to one in another format; ``options`` are the writer's."""
    append(source, target, fmt, **options)


def publish_day(
    spark: SparkSession,
    store: str,
    zones: DataFrame,
    day: str,
    services: tuple[str, ...] = ("yellow", "green"),
    folder: str | None = None,
    limit: int | None = None,
) -> dict[str, dict[str, str]]:
    """The daily and zone tables of each service; gives back their names."""
    names = {}
    for service in services:
        trips = read_month_to_date(spark, store, service, day)
        tables = names[service] = daily_table_names(service, day)
        place = {key: f"{folder}/{name}" if folder else None for key, name in tables.items()}
        reports = {
            "daily": (daily_kpis_on(trips, service, day), ["date"]),
            "zones": (zone_kpis_on(trips, zones, service, day), ["date", "pulocationid"]),
        }
        for key, (report, order) in reports.items():
            publish(report, tables[key], ("date",), limit, order, place[key], part=day)
    return names
