"""Joins with a dimension table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only if it has been seen to stay below both bounds.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(side: DataFrame, rows: int = BROADCAST_ROWS, n_bytes: int = BROADCAST_BYTES) -> bool:
    """Counts rows and bytes of at most ``rows`` + 1 rows."""
    size = F.octet_length(F.to_json(F.struct(*side.columns)))
    seen = side.limit(rows + 1).agg(F.count("*").alias("n"), F.sum(size).alias("b")).first()
    return seen["n"] <= rows and (seen["b"] or 0) <= n_bytes


def small_side(side: DataFrame, rows: int = BROADCAST_ROWS, n_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The side with a broadcast hint if it is small enough, else as it is.

    Without the hint Spark joins by sort-merge, and adaptive execution splits
    the partitions of hot keys.
    """
    return F.broadcast(side) if fits_broadcast(side, rows, n_bytes) else side


def add_coordinates(
    trips: DataFrame, zones: DataFrame, location: str, latitude: str, longitude: str, how: str = "left"
) -> DataFrame:
    """Adds the coordinates of the zone in ``location``, unless they are there already."""
    if latitude in trips.columns:
        return trips
    places = zones.select(
        F.col("LocationID").alias(location),
        F.col("latitude").alias(latitude),
        F.col("longitude").alias(longitude),
    )
    return trips.join(places, location, how)


def add_both_coordinates(trips: DataFrame, zones: DataFrame, how: str = "left") -> DataFrame:
    """The zone table in two roles: pick-up and drop-off."""
    picked = add_coordinates(trips, zones, "pulocationid", "pickup_latitude", "pickup_longitude", how)
    return add_coordinates(picked, zones, "dolocationid", "dropoff_latitude", "dropoff_longitude", how)


def add_zone_names(df: DataFrame, zones: DataFrame, location: str, names=("zone",), how: str = "left") -> DataFrame:
    """Adds zone columns; ``how="inner"`` drops rows of unknown zones."""
    places = zones.select(F.col("LocationID").alias(location), *names)
    return df.join(places, location, how)


def glue(keys: list[str], first: DataFrame, *others: DataFrame) -> DataFrame:
    """Left-joins tables that hold one row per key."""
    for other in others:
        first = first.join(other, keys, "left")
    return first


def colliding(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """Rows of the left whose key value occurs on the right.

    Copies on the right are removed before the shuffle, so no key is hot there;
    a hot key on the left is split by adaptive execution.
    """
    return left.join(right.select(key).distinct(), key, "left_semi")


def not_colliding(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    return left.join(right.select(key).distinct(), key, "left_anti")
