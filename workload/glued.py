"""The day's report from tables that exist on their own, to compare with the one-pass report."""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.functions.calendar import seconds_between
from farelane.functions.measures import mean, mean_minutes, total
from farelane.operators.lookups import glue
from farelane.plans.daily import DAILY_COLUMNS, month_to_date, month_to_date_revenue


def daily_tables_glued(trips: DataFrame, service: str, day: str) -> DataFrame:
    """The report of one day put together from separate tables and the month's total.

    For tables that already exist on their own; ``daily_kpis_on`` needs one pass.
    """
    asked = F.lit(Date.fromisoformat(day))
    on_day = month_to_date(trips, service, day).where(
        (F.col("trip_day") == asked) & (F.to_date("pickup_datetime") == asked)
    )
    by_day = on_day.groupBy(F.col("trip_day").alias("date"))
    seconds = seconds_between("pickup_datetime", "dropoff_datetime")
    money = by_day.agg(
        total("total_amount").alias("revenue_of_day"),
        mean("tip_amount").alias("avg_tip_amount"),
        total("fare_amount").alias("total_fare"),
    )
    travel = by_day.agg(
        total("trip_distance").alias("total_trip_distance"),
        mean_minutes(seconds).alias("avg_trip_time"),
        total("passenger_count").alias("total_customer"),
    )
    month = month_to_date_revenue(trips, service, day).scalar()
    return glue(["date"], money, travel).withColumn("revenue_of_month", month).select(*DAILY_COLUMNS)
