"""Pinned schemas: nothing below is ever inferred from data."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


# Column names and types of the green after-image, times in epoch microseconds.
GREEN_AFTER = _struct(
    ("vendorid", IntegerType()),
    ("lpep_pickup_datetime", LongType()),
    ("lpep_dropoff_datetime", LongType()),
    ("store_and_fwd_flag", StringType()),
    ("ratecodeid", DoubleType()),
    ("pulocationid", IntegerType()),
    ("dolocationid", IntegerType()),
    ("passenger_count", DoubleType()),
    ("trip_distance", DoubleType()),
    ("fare_amount", DoubleType()),
    ("extra", DoubleType()),
    ("mta_tax", DoubleType()),
    ("tip_amount", DoubleType()),
    ("tolls_amount", DoubleType()),
    ("improvement_surcharge", DoubleType()),
    ("total_amount", DoubleType()),
    ("payment_type", DoubleType()),
    ("trip_type", DoubleType()),
    ("congestion_surcharge", DoubleType()),
    ("id", StringType()),
    ("id_customer", LongType()),
    ("rate", DoubleType()),
)

# Columns of the after-image that hold epoch microseconds.
GREEN_TIMES = ("lpep_pickup_datetime", "lpep_dropoff_datetime")

# Header of the zone lookup file.
ZONE_LOOKUP = _struct(
    ("LocationID", IntegerType()),
    ("Borough", StringType()),
    ("zone", StringType()),
    ("service_zone", StringType()),
    ("latitude", DoubleType()),
    ("longitude", DoubleType()),
)

# Metadata part of a media message, all text.
MEDIA_METADATA = _struct(
    ("id", StringType()),
    ("year", StringType()),
    ("month", StringType()),
    ("day", StringType()),
)

MEDIA_OBJECT = _struct(
    ("path", StringType()),
    ("content_type", StringType()),
    ("n_bytes", LongType()),
    ("content", BinaryType()),
)

CUSTOMER_COUNT = _struct(("id_customer", LongType()), ("customer_count", LongType()))


def change_envelope(after: StructType = GREEN_AFTER) -> StructType:
    """The parts of a change message that are read; the rest is skipped while parsing."""
    payload = _struct(("after", after), ("op", StringType()), ("ts_ms", LongType()))
    return _struct(("payload", payload), (CORRUPT, StringType()))


# Column that receives the text of a message that is not valid JSON.
CORRUPT = "_corrupt_record"
