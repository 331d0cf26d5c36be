"""Ids, customers and ratings for trips that come without them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.functions.draws import pick_index, rating
from farelane.functions.text import zero_fill
from farelane.operators.lookups import small_side
from farelane.operators.numbering import number_rows

ID_DIGITS = 8


def add_trip_ids(
    trips: DataFrame, order: list[str], year: str = "year", month: str = "month", unique: bool = False
) -> DataFrame:
    """``id`` = year, month and the zero-filled row number within that month; ``unique`` as in ``number_rows``."""
    numbered = number_rows(trips, "_number", order, [year, month], unique)
    text = F.concat(F.col(year), F.col(month), zero_fill(F.col("_number"), ID_DIGITS))
    return numbered.withColumn("id", text).drop("_number")


def add_customers(trips: DataFrame, customers: DataFrame, draw: Column, id_column: str = "id") -> DataFrame:
    """``id_customer``: for each trip one customer of the list, drawn uniformly with replacement."""
    numbered = number_rows(customers.select(F.col(id_column).alias("id_customer")), "_number", ["id_customer"])
    listed = numbered.select((F.col("_number") - 1).alias("_index"), "id_customer")
    size = listed.count()
    if size == 0:
        raise ValueError("the customer list is empty")
    return trips.withColumn("_index", pick_index(draw, size)).join(small_side(listed), "_index").drop("_index")


def add_rating(trips: DataFrame, draw: Column) -> DataFrame:
    return trips.withColumn("rate", rating(draw))


def ensure_customer(trips: DataFrame, n_customers: int, draw: Column) -> DataFrame:
    """Gives trips without ``id_customer`` one in 1..n."""
    if "id_customer" in trips.columns:
        return trips
    return trips.withColumn("id_customer", pick_index(draw, n_customers) + 1)


def normalize_customers(customers: DataFrame) -> DataFrame:
    """Ids as text of at least eight digits, first names dropped."""
    return customers.drop("firstname").withColumn("id", zero_fill(F.col("id"), ID_DIGITS))
