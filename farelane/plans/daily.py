"""Reports per day: totals, month to date, zones."""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelane.functions.calendar import first_of_month, seconds_between
from farelane.functions.measures import mean, mean_minutes, total
from farelane.operators.lookups import add_zone_names

# Names and order of the daily report's columns.
DAILY_COLUMNS = (
    "date",
    "revenue_of_day",
    "revenue_of_month",
    "avg_tip_amount",
    "total_fare",
    "total_trip_distance",
    "avg_trip_time",
    "total_customer",
)


def daily_kpis(trips: DataFrame) -> DataFrame:
    """One row per service and day with trips picked up on that day.

    A day's trips are those dropped off on it (``trip_day``, the way they are
    stored); the day's measures cover those picked up on it too, the running
    month total covers all of them. One pass over the trips; the window runs
    over a few rows per day, one for each pick-up date.
    """
    days = trips.groupBy("service", "trip_day", F.to_date("pickup_datetime").alias("date")).agg(
        total("total_amount").alias("revenue_of_day"),
        mean("tip_amount").alias("avg_tip_amount"),
        total("fare_amount").alias("total_fare"),
        total("trip_distance").alias("total_trip_distance"),
        mean_minutes(seconds_between("pickup_datetime", "dropoff_datetime")).alias("avg_trip_time"),
        total("passenger_count").alias("total_customer"),
    )
    so_far = (
        Window.partitionBy("service", first_of_month("trip_day"))
        .orderBy("trip_day")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        days.withColumn("revenue_of_month", F.sum("revenue_of_day").over(so_far))
        .where("date = trip_day")
        .select("service", *DAILY_COLUMNS)
    )


def month_to_date(trips: DataFrame, service: str, day: str) -> DataFrame:
    """Trips stored under the first of the month up to the day; one scan, pruned by day."""
    asked = Date.fromisoformat(day)
    return trips.where(
        (F.col("service") == service) & F.col("trip_day").between(F.lit(asked.replace(day=1)), F.lit(asked))
    )


def daily_kpis_on(trips: DataFrame, service: str, day: str) -> DataFrame:
    """The row of one service and day; empty if nothing was picked up."""
    asked = Date.fromisoformat(day)
    report = daily_kpis(month_to_date(trips, service, day))
    return report.where(F.col("date") == F.lit(asked)).select(*DAILY_COLUMNS)


def month_to_date_revenue(trips: DataFrame, service: str, day: str) -> DataFrame:
    """One row, null without trips."""
    return month_to_date(trips, service, day).agg(total("total_amount").alias("revenue_of_month"))


def running_month_revenue(trips: DataFrame) -> DataFrame:
    """Revenue by pick-up date and its running total within the month."""
    days = trips.groupBy("service", F.to_date("pickup_datetime").alias("date")).agg(
        total("total_amount").alias("revenue_of_day")
    )
    so_far = (
        Window.partitionBy("service", first_of_month("date"))
        .orderBy("date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return days.withColumn("running_revenue", F.sum("revenue_of_day").over(so_far))


# Names and order of the zone report's columns.
ZONE_COLUMNS = (
    "date",
    "pulocationid",
    "zone",
    "total_amount",
    "avg_tip_amount",
    "total_fare",
    "avg_trip_distance",
    "avg_tolls_amount",
    "avg_congestion_surcharge",
    "total_trip_count",
)


def zone_kpis(trips: DataFrame, zones: DataFrame, how: str = "left") -> DataFrame:
    """One row per service, stored day and pick-up zone.

    The zone name is joined to the aggregated rows, so no hint is needed there:
    Spark picks the join from the sizes it sees. ``total_trip_count`` counts
    known zone ids, so it is 0 in the row of trips without one. ``how="inner"``
    drops unknown zones.
    """
    grouped = trips.groupBy("service", F.col("trip_day").alias("date"), "pulocationid").agg(
        total("total_amount").alias("total_amount"),
        mean("tip_amount").alias("avg_tip_amount"),
        total("fare_amount").alias("total_fare"),
        mean("trip_distance").alias("avg_trip_distance"),
        mean("tolls_amount").alias("avg_tolls_amount"),
        mean("congestion_surcharge").alias("avg_congestion_surcharge"),
        F.count("pulocationid").alias("total_trip_count"),
    )
    return add_zone_names(grouped, zones, "pulocationid", how=how).select("service", *ZONE_COLUMNS)


def zone_kpis_on(trips: DataFrame, zones: DataFrame, service: str, day: str) -> DataFrame:
    asked = trips.where((F.col("service") == service) & (F.col("trip_day") == F.lit(Date.fromisoformat(day))))
    return zone_kpis(asked, zones).select(*ZONE_COLUMNS)


def part_of_day_mix(trips: DataFrame) -> DataFrame:
    """Trips per service and part of the day; needs ``pickup_time_of_day``."""
    return trips.groupBy("service", "pickup_time_of_day").agg(F.count("*").alias("trips"))
