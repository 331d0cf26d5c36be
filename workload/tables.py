"""Trip tables read off the given ones.

Line items stand in for trips, nations for zones, documents for media files.
Money comes in quarters, so sums are exact in double and do not depend on the
order of rows. No stand-in needs a join or a shuffle, and filters on service,
customer and zone reach the file scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.operators.columns import select_if
from farelane.sources.streams import table_stream
from farelane.streaming.changes import encode_changes

# The unique key of a line item.
KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _quarters(value):
    return F.floor(value * 4).cast("double") / 4


def _measures() -> dict:
    price, tax = F.col("l_extendedprice"), F.col("l_tax")
    fare = F.floor(price).cast("double")
    extra = F.col("l_linenumber") * F.lit(0.5)
    tip = _quarters(price * F.col("l_discount"))
    tolls = _quarters(price * tax)
    congestion = (F.col("l_suppkey") % 2) * F.lit(2.5)
    return {
        "passenger_count": F.col("l_quantity"),
        "trip_distance": F.col("l_quantity") / 2,
        "fare_amount": fare,
        "extra": extra,
        "mta_tax": F.lit(0.5),
        "tip_amount": tip,
        "tolls_amount": tolls,
        "improvement_surcharge": F.lit(1.0),
        "total_amount": _quarters(price * (F.lit(1.0) + tax)),
        "congestion_surcharge": congestion,
    }


def _times() -> tuple:
    minute = (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 61) % 1440
    start = F.col("l_shipdate") + F.make_dt_interval(mins=minute.cast("int"))
    return start, start + F.make_dt_interval(mins=(F.col("l_quantity") + 5).cast("int"))


def _service():
    return F.when(F.col("l_returnflag") == "R", F.lit("green")).otherwise(F.lit("yellow"))


def _places() -> dict:
    return {
        "pulocationid": F.nullif(F.col("l_suppkey") % 30, F.lit(29)).cast("int"),
        "dolocationid": (F.col("l_partkey") % 30).cast("int"),
    }


def _codes() -> dict:
    return {
        "vendorid": (1 + F.col("l_suppkey") % 2).cast("int"),
        "ratecodeid": (1 + F.col("l_linenumber") % 6).cast("double"),
        "payment_type": F.when(F.col("l_orderkey") % 50 != 0, (1 + F.col("l_linenumber") % 5).cast("double")),
        "store_and_fwd_flag": F.when(F.col("l_linestatus") == "F", F.lit("Y")).otherwise(F.lit("N")),
    }


def _columns(*groups: dict) -> list:
    return [column.alias(name) for group in groups for name, column in group.items()]


def _as_read(df: DataFrame, columns: list) -> DataFrame:
    """The columns as if a file held them: filters on them do not compute them again."""
    return select_if(df, F.lit(True), *columns)


def trips(line_items: DataFrame) -> DataFrame:
    """All trips of both services as stored, with the key of the line item."""
    start, end = _times()
    columns = _columns(
        {"service": _service(), "trip_day": F.to_date(end), "pickup_datetime": start, "dropoff_datetime": end},
        _places(),
        _measures(),
        {"id_customer": F.col("l_partkey")},
        {name: F.col(name) for name in KEY},
    )
    return line_items.select(*columns)


def items_near(line_items: DataFrame, first: str, last: str) -> DataFrame:
    """Line items whose trips may end between two days: a trip ends on the ship date or the day after.

    Does for the scan what the folders of a trip store do.
    """
    early = F.lit(first).cast("date") - F.expr("INTERVAL 1 DAY")
    return line_items.where(F.col("l_shipdate").between(early, F.lit(last).cast("date")))


def _green_columns() -> list:
    start, end = _times()
    return _columns(
        {"lpep_pickup_datetime": start, "lpep_dropoff_datetime": end},
        _codes(),
        _places(),
        _measures(),
        {
            "trip_type": F.when(F.col("l_orderkey") % 40 != 0, (1 + F.col("l_linenumber") % 2).cast("double")),
            "id": F.concat_ws("-", *KEY),
            "id_customer": F.col("l_partkey"),
            "rate": 1 + (F.col("l_orderkey") % 9) * F.lit(0.5),
        },
    )


def raw_green(line_items: DataFrame) -> DataFrame:
    """Green trips as they arrive: all columns of the after-image."""
    return _as_read(line_items.where("l_returnflag = 'R'"), _green_columns())


def raw_yellow(line_items: DataFrame) -> DataFrame:
    """Yellow trips as they arrive: mixed-case names, codes as floating point."""
    start, end = _times()
    codes, places = _codes(), _places()
    columns = _columns(
        {
            "VendorID": codes["vendorid"].cast("double"),
            "tpep_pickup_datetime": start,
            "tpep_dropoff_datetime": end,
            "RatecodeID": codes["ratecodeid"],
            "store_and_fwd_flag": codes["store_and_fwd_flag"],
            "payment_type": codes["payment_type"],
            "PULocationID": places["pulocationid"].cast("double"),
            "DOLocationID": places["dolocationid"].cast("double"),
            "Airport_fee": F.when(F.col("l_partkey") % 70 != 0, F.lit(1.25)),
        },
        _measures(),
        {"id": F.concat_ws("-", *KEY), "id_customer": F.col("l_partkey")},
    )
    return _as_read(line_items.where("l_returnflag <> 'R'"), columns)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones 0 to 24; trips also name 25 to 28, which do not exist."""
    nation, region = given(spark, sf_dir, "nation"), given(spark, sf_dir, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("zone"),
        F.col("r_name").alias("service_zone"),
        (F.lit(40.5) + F.col("n_nationkey") * F.lit(0.125)).alias("latitude"),
        (F.lit(-74.5) + F.col("n_nationkey") * F.lit(0.25)).alias("longitude"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("firstname"), F.col("c_mktsegment").alias("segment")
    )


def media_files(documents: DataFrame) -> DataFrame:
    """Whole documents as payloads; one in fifty has no id."""
    doc = F.col("doc_id")
    return documents.select(
        F.when(doc % 50 == 7, F.lit("")).otherwise(doc.cast("string")).alias("id"),
        F.lit("2024").alias("year"),
        F.lpad((doc % 12 + 1).cast("string"), 2, "0").alias("month"),
        F.lpad((doc % 28 + 1).cast("string"), 2, "0").alias("day"),
        F.encode("text", "UTF-8").alias("content"),
        "doc_id",
    )


def whole_changes(line_items: DataFrame, *keep: str) -> DataFrame:
    """Change messages of the green trips, a batch or a stream, some of them deletes."""
    green = line_items.where("l_returnflag = 'R'").select(*_green_columns(), *KEY)
    order = F.col("l_orderkey")
    op = F.when(order % 97 == 0, "d").when(order % 3 == 0, "u").otherwise("c")
    return encode_changes(green, op=op, keep=keep)


def change_messages(line_items: DataFrame) -> DataFrame:
    """As ``whole_changes``, with some messages broken and some empty."""
    order, messages = F.col("l_orderkey"), whole_changes(line_items, "l_orderkey")
    broken = F.when(order % 101 == 0, F.substring("value", 1, 12)).when(order % 103 != 0, F.col("value"))
    return messages.select(broken.alias("value"))


def given_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a stream of files, be it one file or a folder of them.

    Only a pattern may name a single file, so one letter of the name is written as one.
    """
    place = f"{sf_dir}/[{name[0]}]{name[1:]}.parquet"
    return table_stream(spark, place, given(spark, sf_dir, name).schema)


def line_items_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items as a stream of files."""
    return given_stream(spark, sf_dir, "lineitem")


def documents_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given_stream(spark, sf_dir, "documents")
