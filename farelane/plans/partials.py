"""Mergeable sums of stored trips, so that reports read days again only when they were replaced.

A row of partials holds sums and counts of one service, source, stored day, pick-up date and
zone. Sums of sums are the sums of the trips, so day, month-to-date and zone reports follow
from partials alone, whatever the number of sources that share a day.
"""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farelane.functions.calendar import first_of_month, seconds_between
from farelane.operators.lookups import add_zone_names
from farelane.plans.daily import DAILY_COLUMNS, ZONE_COLUMNS
from farelane.sinks.store import DAY_KEY, SOURCE_KEYS, replace_source, write_store

PARTIAL_KEYS = (*SOURCE_KEYS, DAY_KEY, "date", "pulocationid")
# The measures that reports add up.
MEASURES = (
    "total_amount", "tip_amount", "fare_amount", "trip_distance", "passenger_count", "tolls_amount", "congestion_surcharge",
)
SECONDS = "seconds"


def day_partials(trips: DataFrame, *folders: str) -> DataFrame:
    """Sums and counts of known values by ``PARTIAL_KEYS``; ``folders`` are kept as further keys."""
    timed = trips.withColumns({"date": F.to_date("pickup_datetime"), SECONDS: seconds_between("pickup_datetime", "dropoff_datetime")})
    keys = [*PARTIAL_KEYS, *(f for f in folders if f not in PARTIAL_KEYS)]
    sums = [F.sum(m).alias(f"{m}_sum") for m in (*MEASURES, SECONDS)]
    known = [F.count(m).alias(f"{m}_n") for m in (*MEASURES, SECONDS)]
    return timed.groupBy(*keys).agg(F.count("*").alias("trips"), *sums, *known)


def refresh_partials(
    spark: SparkSession,
    store: str,
    target: str,
    service: str,
    source: str,
    only: Column | None = None,
    below: tuple[str, ...] = (DAY_KEY,),
) -> None:
    """Makes the partials of one source those of its trips, from its folders of the store alone.

    ``only`` names the folders that were replaced, by a condition on ``below``: the others are
    neither read nor written. Without it the whole source is done again, which also drops the
    partials of days that have gone; a source without trips leaves none.
    """
    stored = spark.read.parquet(store).where((F.col("service") == service) & (F.col("source").cast("string") == source))
    if only is None:
        replace_source(day_partials(stored, *below), target, service, source, below)
    else:
        write_store(day_partials(stored.where(only), *below), target, (*SOURCE_KEYS, *below))


def _total(name: str) -> Column:
    return F.sum(f"{name}_sum").cast("double")


def _mean(name: str) -> Column:
    return F.try_divide(_total(name), F.sum(f"{name}_n"))


def merged_daily_kpis(partials: DataFrame) -> DataFrame:
    """The report of ``daily_kpis`` from partials."""
    days = partials.groupBy("service", DAY_KEY, "date").agg(
        _total("total_amount").alias("revenue_of_day"),
        _mean("tip_amount").alias("avg_tip_amount"),
        _total("fare_amount").alias("total_fare"),
        _total("trip_distance").alias("total_trip_distance"),
        F.try_divide(_total(SECONDS), F.sum(f"{SECONDS}_n") * 60).alias("avg_trip_time"),
        _total("passenger_count").alias("total_customer"),
    )
    so_far = (
        Window.partitionBy("service", first_of_month(DAY_KEY))
        .orderBy(DAY_KEY)
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    months = days.withColumn("revenue_of_month", F.sum("revenue_of_day").over(so_far))
    return months.where(f"date = {DAY_KEY}").select("service", *DAILY_COLUMNS)


def merged_zone_kpis(partials: DataFrame, zones: DataFrame, how: str = "left") -> DataFrame:
    """The report of ``zone_kpis`` from partials."""
    known_zone = F.when(F.col("pulocationid").isNotNull(), F.col("trips")).otherwise(0)
    grouped = partials.groupBy("service", F.col(DAY_KEY).alias("date"), "pulocationid").agg(
        _total("total_amount").alias("total_amount"),
        _mean("tip_amount").alias("avg_tip_amount"),
        _total("fare_amount").alias("total_fare"),
        _mean("trip_distance").alias("avg_trip_distance"),
        _mean("tolls_amount").alias("avg_tolls_amount"),
        _mean("congestion_surcharge").alias("avg_congestion_surcharge"),
        F.sum(known_zone).alias("total_trip_count"),
    )
    return add_zone_names(grouped, zones, "pulocationid", how=how).select("service", *ZONE_COLUMNS)


def merged_month_to_date(partials: DataFrame, service: str, day: str) -> DataFrame:
    """One row: revenue of the month up to the day, null without trips."""
    asked = Date.fromisoformat(day)
    month = partials.where((F.col("service") == service) & F.col(DAY_KEY).between(F.lit(asked.replace(day=1)), F.lit(asked)))
    return month.agg(_total("total_amount").alias("revenue_of_month"))
