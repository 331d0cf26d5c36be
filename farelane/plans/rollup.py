"""Wide fact table for the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.functions.calendar import with_calendar_columns
from farelane.functions.measures import total
from farelane.functions.text import service_type

# Output key and source column.
KEYS = {
    "year": "year",
    "month": "month",
    "dow": "dow",
    "vendor_id": "vendorid",
    "rate_code_id": "ratecodeid",
    "pickup_location_id": "pulocationid",
    "dropoff_location_id": "dolocationid",
    "payment_type_id": "payment_type",
    "pickup_datetime": "pickup_datetime",
    "dropoff_datetime": "dropoff_datetime",
    "pickup_latitude": "pickup_latitude",
    "pickup_longitude": "pickup_longitude",
    "dropoff_latitude": "dropoff_latitude",
    "dropoff_longitude": "dropoff_longitude",
}
SUMS = (
    "passenger_count",
    "trip_distance",
    "extra",
    "mta_tax",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "total_amount",
    "improvement_surcharge",
    "congestion_surcharge",
)


def fact_rollup(trips: DataFrame, name: str) -> DataFrame:
    """Sums per calendar, code and place keys; ``service_type`` is read off the file or service name.

    The calendar keys follow from the pick-up time, so they are added after the
    shuffle instead of being carried through it.
    """
    source = [F.col(old).alias(new) for new, old in KEYS.items() if new not in ("year", "month", "dow")]
    sums = trips.groupBy(*source).agg(*[total(column).alias(column) for column in SUMS])
    marked = with_calendar_columns(sums).withColumn("service_type", service_type(F.lit(name)))
    return marked.select(*KEYS, *SUMS, "service_type")
