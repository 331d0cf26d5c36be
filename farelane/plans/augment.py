"""Monthly trip files completed with ids, customers and ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.functions.draws import hash_draw
from farelane.operators.augment import add_customers, add_rating, add_trip_ids
from farelane.sinks.store import write_store
from farelane.sources.files import read_month_files

MONTH_KEYS = ("service", "year", "month")


def augment_trips(
    trips: DataFrame, customers: DataFrame, order: list[str], draw=hash_draw, seed: int = 42, unique: bool = False
) -> DataFrame:
    """``id``, ``id_customer`` and ``rate`` for trips that carry ``year`` and ``month``.

    Ids count up within each month in ``order``. Customer and rating are drawn
    from the id, so the same trips always get the same ones.
    """
    numbered = add_trip_ids(trips.drop("ehail_fee"), order, unique=unique)
    with_customer = add_customers(numbered, customers, draw("id", seed=seed))
    return add_rating(with_customer, draw("id", seed=seed + 1))


def augment_month_files(
    spark: SparkSession,
    root: str,
    service: str,
    customers: DataFrame,
    order: list[str],
    target: str,
    draw=hash_draw,
    unique: bool = False,
) -> None:
    """All monthly files of a service, read in one scan, into folders by service, year and month.

    Each service is numbered on its own; ``order`` should settle the place of
    every trip within its month.
    """
    trips = read_month_files(spark, root, service).withColumn("service", F.lit(service))
    write_store(augment_trips(trips, customers, order, draw, unique=unique), target, MONTH_KEYS)
