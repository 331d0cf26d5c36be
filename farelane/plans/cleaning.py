"""Raw trips of one service to the processed form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.operators.columns import (
    alphabetical,
    cast_present,
    drop_containing,
    drop_incomplete,
    fill_zero,
    is_known,
    lower_case_names,
)
from farelane.operators.lookups import add_both_coordinates, small_side

# Column names of the two services.
RENAMES = {
    "green": {"lpep_pickup_datetime": "pickup_datetime", "lpep_dropoff_datetime": "dropoff_datetime"},
    "yellow": {
        "tpep_pickup_datetime": "pickup_datetime",
        "tpep_dropoff_datetime": "dropoff_datetime",
        "airport_fee": "fee",
    },
}
# Types of times and codes in the processed form.
TYPES = {
    "pickup_datetime": "timestamp",
    "dropoff_datetime": "timestamp",
    "payment_type": "int",
    "dolocationid": "int",
    "pulocationid": "int",
    "vendorid": "int",
}
FLAG = "store_and_fwd_flag"
UNWANTED = {"green": ("trip_type",), "yellow": ("fee",)}
COORDINATES = ("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")


def _names_and_types(df: DataFrame, service: str) -> DataFrame:
    renamed = df.withColumnsRenamed(RENAMES[service]).drop(*UNWANTED[service])
    return cast_present(fill_zero(renamed, "payment_type"), TYPES)


def clean_trips(
    raw: DataFrame, zones: DataFrame, service: str, null_policy: str = "strict", how: str = "left"
) -> DataFrame:
    """Processed trips: pinned names and types, coordinates, no missing value, columns in order.

    ``strict`` drops a row for any missing value, also in columns that are
    dropped afterwards. ``intent`` drops those columns and fills the payment
    type first, and only then looks for missing values.

    Missing values are filtered before the zone joins, so the file scan can
    skip them; a trip of an unknown zone gets no coordinates and goes last.
    """
    if null_policy not in ("strict", "intent"):
        raise ValueError(f"unknown null policy: {null_policy}")
    zones = small_side(drop_containing(zones, "Unnamed"))
    df = drop_containing(lower_case_names(raw).drop(FLAG), "unnamed")
    if null_policy == "strict":
        complete = drop_incomplete(df)
        joined = drop_incomplete(add_both_coordinates(complete, zones, how), *COORDINATES)
        typed = _names_and_types(joined, service)
        return alphabetical(drop_incomplete(typed, *[name for name in TYPES if name in typed.columns]))
    typed = drop_incomplete(_names_and_types(df.drop("ehail_fee"), service))
    return alphabetical(drop_incomplete(add_both_coordinates(typed, zones, how), *COORDINATES))


def cleaning_audit(raw: DataFrame, zones: DataFrame, service: str) -> DataFrame:
    """One row: rows read, rows that survive ``strict`` and the reasons for the loss, in one pass.

    A row may have several reasons, so they need not add up to the loss.
    """
    zones = small_side(drop_containing(zones, "Unnamed"))
    df = drop_containing(lower_case_names(raw).drop(FLAG), "unnamed")
    joined = add_both_coordinates(df, zones)
    pickup = next(old for old, new in RENAMES[service].items() if new == "pickup_datetime")
    known = {name: is_known(joined, name) for name in joined.columns}
    lost_column = ~reduce(lambda a, b: a & b, (known[name] for name in df.columns))
    lost_pickup = known["pulocationid"] & ~known["pickup_latitude"]
    lost_dropoff = known["dolocationid"] & ~known["dropoff_latitude"]
    return joined.agg(
        F.lit(service).alias("service"),
        F.count("*").alias("rows_in"),
        F.count_if(reduce(lambda a, b: a & b, known.values())).alias("rows_out"),
        F.count_if(lost_column).alias("missing_value"),
        F.count_if(~known["payment_type"]).alias("missing_payment_type"),
        F.count_if(lost_pickup).alias("unknown_pickup_zone"),
        F.count_if(lost_dropoff).alias("unknown_dropoff_zone"),
        F.min(pickup).alias("first_pickup"),
        F.max(pickup).alias("last_pickup"),
    )

