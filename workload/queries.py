"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import math
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from farelane.functions.calendar import with_calendar_columns, with_habit_columns
from farelane.functions.draws import digest_draw
from farelane.functions.text import day_path
from farelane.operators.augment import (
    add_customers,
    add_rating,
    add_trip_ids,
    ensure_customer,
    normalize_customers,
)
from farelane.operators.columns import drop_containing
from farelane.operators.lookups import add_both_coordinates, colliding, not_colliding, small_side
from farelane.operators.ranking import sample_exact, top_by_sketch
from farelane.plans import customers as people
from farelane.plans import daily
from farelane.plans.augment import augment_month_files, augment_trips
from farelane.plans.cleaning import clean_trips, cleaning_audit
from farelane.plans.ingest import clean_month_files, convert_table, ingest_raw, publish_day, raw_to_processed
from farelane.plans.partials import merged_daily_kpis, merged_zone_kpis, refresh_partials
from farelane.plans.rollup import fact_rollup
from farelane.schemas import GREEN_AFTER, ZONE_LOOKUP
from farelane.scratch import qualified, scratch_folder
from farelane.sinks.exports import write_csv, write_text_messages
from farelane.sinks.objects import get_objects, put_object
from farelane.sinks.store import SOURCE_KEYS, append, read_day, read_month_to_date, replace_source, write_store
from farelane.sinks.tables import publish
from farelane.sources.files import read_csv, read_latest, read_month_files, read_recursive, read_table, read_zone_lookup, run_query
from farelane.sources.streams import table_stream, text_messages
from farelane.streaming import changes, media
from workload import tables
from workload.glued import daily_tables_glued

Query = Callable[[SparkSession, str], DataFrame]

DAY = "1998-03-17"
SERVICE = "yellow"
TOP_K = 10
CUSTOMER = 151
SAMPLE_ROWS = 1000
STORE_FILES = 4
DRAWN_CUSTOMERS = 300
PUBLISHED_ROWS = 50
# A bound that refuses some messages at every scale; the product's bound is MAX_MESSAGE_BYTES.
MEDIA_BYTES = 16 * 1024
# Seconds a test stream may take before it counts as stuck.
STREAM_SECONDS = 3600

QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.given(spark, sf_dir, "lineitem")


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.trips(_items(spark, sf_dir))


def _month_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of the month of ``DAY`` up to that day, and a few more."""
    return tables.trips(tables.items_near(_items(spark, sf_dir), f"{DAY[:7]}-01", DAY))


def _raw(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    read = tables.raw_green if service == "green" else tables.raw_yellow
    return read(_items(spark, sf_dir))


def _local_times(df: DataFrame) -> DataFrame:
    """Instants as local times, the form in which the given tables hold them."""
    instants = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in instants})


# Reports per day and zone


@register
def daily_kpis(spark, sf_dir):
    return daily.daily_kpis(_trips(spark, sf_dir))


@register
def daily_kpis_one_day(spark, sf_dir):
    return daily.daily_kpis_on(_month_trips(spark, sf_dir), SERVICE, DAY)


@register
def daily_kpis_joined_form(spark, sf_dir):
    return daily_tables_glued(_month_trips(spark, sf_dir), SERVICE, DAY)


@register
def month_to_date_revenue(spark, sf_dir):
    return daily.month_to_date_revenue(_month_trips(spark, sf_dir), SERVICE, DAY)


@register
def revenue_running_month(spark, sf_dir):
    return daily.running_month_revenue(_trips(spark, sf_dir))


@register
def zone_kpis(spark, sf_dir):
    return daily.zone_kpis(_trips(spark, sf_dir), tables.zones(spark, sf_dir))


@register
def zone_kpis_known_only(spark, sf_dir):
    return daily.zone_kpis(_trips(spark, sf_dir), tables.zones(spark, sf_dir), how="inner")


@register
def zone_kpis_one_day(spark, sf_dir):
    return daily.zone_kpis_on(_month_trips(spark, sf_dir), tables.zones(spark, sf_dir), SERVICE, DAY)


@register
def part_of_day_mix(spark, sf_dir):
    return daily.part_of_day_mix(with_habit_columns(_trips(spark, sf_dir)))


@register
def calendar_mix(spark, sf_dir):
    """Trips per calendar key of the pick-up, with the folder of each day."""
    keys = ["year", "month", "dow", "pickup_hour", "pickup_date", "pickup_month"]
    counted = with_calendar_columns(_trips(spark, sf_dir)).groupBy(*keys).agg(F.count("*").alias("trips"))
    return counted.withColumn("folder", day_path("data", F.col("pickup_date")))


# Cleaning


def _processed(spark, sf_dir, service, null_policy="strict", how="left"):
    return clean_trips(_raw(spark, sf_dir, service), tables.zones(spark, sf_dir), service, null_policy, how)


def _cleaned(*args, **options):
    return _local_times(_processed(*args, **options))


@register
def clean_trips_strict(spark, sf_dir):
    return _cleaned(spark, sf_dir, "yellow")


@register
def clean_trips_strict_green(spark, sf_dir):
    return _cleaned(spark, sf_dir, "green")


@register
def clean_trips_intent(spark, sf_dir):
    return _cleaned(spark, sf_dir, "yellow", "intent")


@register
def clean_trips_intent_green(spark, sf_dir):
    return _cleaned(spark, sf_dir, "green", "intent")


@register
def clean_trips_inner_form(spark, sf_dir):
    return _cleaned(spark, sf_dir, "yellow", how="inner")


@register
def clean_audit(spark, sf_dir):
    zones = tables.zones(spark, sf_dir)
    green, yellow = (cleaning_audit(_raw(spark, sf_dir, s), zones, s) for s in ("green", "yellow"))
    return yellow.unionByName(green)


@register
def all_trips_cleaned(spark, sf_dir):
    """Both services in one table, matched by column name."""
    green, yellow = _cleaned(spark, sf_dir, "green").drop("rate"), _cleaned(spark, sf_dir, "yellow")
    return green.unionByName(yellow)


@register
def fact_rollup_all(spark, sf_dir):
    green, yellow = (fact_rollup(_processed(spark, sf_dir, s), f"{s}_tripdata") for s in ("green", "yellow"))
    return _local_times(yellow.unionByName(green))


# Customers


@register
def top_customers(spark, sf_dir):
    return people.top_customers(_trips(spark, sf_dir), TOP_K)


@register
def top_customers_by_sketch(spark, sf_dir):
    """Customers ride about equally often here, so the sketch cannot settle the places and all are counted."""
    return people.top_customers_by_sketch(_trips(spark, sf_dir), TOP_K)


@register
def busiest_zones_by_sketch(spark, sf_dir):
    """Zones are few, so the sketch settles the places."""
    return top_by_sketch(_trips(spark, sf_dir), "pulocationid", TOP_K, "trips")[0]


@register
def top_customer_trips(spark, sf_dir):
    """All trips of the top customers."""
    trips = _trips(spark, sf_dir)
    return people.trips_of(trips, people.top_customers(trips, TOP_K)).select(
        "id_customer", *tables.KEY, "service", "pickup_datetime", "pulocationid", "total_amount"
    )


@register
def top_customer_habits(spark, sf_dir):
    return people.top_customer_habits(_trips(spark, sf_dir), tables.zones(spark, sf_dir), TOP_K)


@register
def top_customer_habits_each(spark, sf_dir):
    return people.top_customer_habits(_trips(spark, sf_dir), tables.zones(spark, sf_dir), TOP_K, mode="each")


@register
def customer_habits(spark, sf_dir):
    return people.customer_habits(_trips(spark, sf_dir))


@register
def customer_habits_ranked(spark, sf_dir):
    return people.ranked_habits(_trips(spark, sf_dir))


@register
def customer_totals(spark, sf_dir):
    return people.customer_totals(_trips(spark, sf_dir))


@register
def customer_totals_drawn(spark, sf_dir):
    """Totals of trips that came without a customer and were given one."""
    trips = _trips(spark, sf_dir).drop("id_customer")
    return people.customer_totals(ensure_customer(trips, DRAWN_CUSTOMERS, digest_draw(*tables.KEY, seed=17)))


@register
def customer_profile(spark, sf_dir):
    return people.customer_profiles(_trips(spark, sf_dir), tables.zones(spark, sf_dir))


@register
def customer_profile_one(spark, sf_dir):
    return people.customer_profile(_trips(spark, sf_dir), tables.zones(spark, sf_dir), CUSTOMER)


# Augmentation


def _trip_key_draw(seed: int):
    return digest_draw(*tables.KEY, seed=seed)


@register
def trips_with_ids(spark, sf_dir):
    trips = _trips(spark, sf_dir).select(
        *tables.KEY,
        "pickup_datetime",
        F.date_format("pickup_datetime", "yyyy").alias("year"),
        F.date_format("pickup_datetime", "MM").alias("month"),
    )
    return add_trip_ids(trips, ["pickup_datetime", *tables.KEY], unique=True)


@register
def trips_with_customers(spark, sf_dir):
    trips = _trips(spark, sf_dir).select(*tables.KEY, "service")
    return add_customers(trips, tables.customers(spark, sf_dir), _trip_key_draw(7))


@register
def trips_with_rating(spark, sf_dir):
    return add_rating(_trips(spark, sf_dir).select(*tables.KEY), _trip_key_draw(11))


@register
def trips_augmented(spark, sf_dir):
    """Ids, customers and ratings for all trips."""
    trips = _trips(spark, sf_dir).select(
        *tables.KEY,
        "pickup_datetime",
        F.date_format("pickup_datetime", "yyyy").alias("year"),
        F.date_format("pickup_datetime", "MM").alias("month"),
    )
    order = ["pickup_datetime", *tables.KEY]
    return augment_trips(trips, tables.customers(spark, sf_dir), order, digest_draw, unique=True)


@register
def customers_normalized(spark, sf_dir):
    return normalize_customers(tables.customers(spark, sf_dir))


def _supplier_ids(spark, sf_dir):
    return normalize_customers(tables.given(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id")))


@register
def customer_id_collisions(spark, sf_dir):
    return colliding(customers_normalized(spark, sf_dir), _supplier_ids(spark, sf_dir))


@register
def customer_id_unused(spark, sf_dir):
    return not_colliding(customers_normalized(spark, sf_dir), _supplier_ids(spark, sf_dir))


@register
def trip_sample(spark, sf_dir):
    trips = _trips(spark, sf_dir).select(*tables.KEY, "service", "total_amount")
    return sample_exact(trips, SAMPLE_ROWS, _trip_key_draw(13), *tables.KEY)


@register
def trip_sample_third(spark, sf_dir):
    """A third of all trips, by the threshold of a large sample at every scale."""
    trips = _trips(spark, sf_dir).select(*tables.KEY, "service", "total_amount")
    return sample_exact(trips, trips.count() // 3, _trip_key_draw(13), *tables.KEY, small=0)


# Stores, tables and files


def _with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("month", F.date_format("trip_day", "yyyy-MM"))


MONTH_KEYS = ("service", "month")


@register
def trips_split_by_day(spark, sf_dir):
    """The whole trip store, written in folders by month with whole days together, counted back by day."""
    store = scratch_folder(spark, "store")
    write_store(_with_month(_trips(spark, sf_dir)), store, MONTH_KEYS, sort=("trip_day",))
    return spark.read.parquet(store).groupBy("service", "trip_day").agg(
        F.count("*").alias("trips"),
        F.min("dropoff_datetime").alias("first_dropoff"),
        F.max("dropoff_datetime").alias("last_dropoff"),
    )


@register
def store_month_to_date(spark, sf_dir):
    """Month-to-date trips read back from a store of all trips."""
    store = scratch_folder(spark, "store")
    write_store(_with_month(_trips(spark, sf_dir)), store, MONTH_KEYS, sort=("trip_day",))
    stored = read_month_to_date(spark, store, SERVICE, DAY)
    return stored.groupBy("pickup_date").agg(F.count("*").alias("trips"), F.sum("total_amount").alias("revenue"))


@register
def store_one_day(spark, sf_dir):
    """The trips of one service and day read back from a store of all trips."""
    store = scratch_folder(spark, "store")
    write_store(_with_month(_trips(spark, sf_dir)), store, MONTH_KEYS, sort=("trip_day",))
    return read_day(spark, store, SERVICE, DAY).select(*tables.KEY, "pickup_date", "pickup_datetime", "total_amount")


@register
def publish_one_day(spark, sf_dir):
    """The daily tables of both services, published from a store of all trips and read back."""
    store, folder = scratch_folder(spark, "store"), scratch_folder(spark, "tables")
    write_store(_with_month(_trips(spark, sf_dir)), store, MONTH_KEYS, sort=("trip_day",))
    names = publish_day(spark, store, tables.zones(spark, sf_dir), DAY, folder=folder)
    yellow, green = (
        run_query(spark, names[s]["daily"]).where(F.col("date") == F.lit(DAY).cast("date")).withColumn("service", F.lit(s))
        for s in ("yellow", "green")
    )
    return yellow.unionByName(green)


@register
def publish_one_day_zones(spark, sf_dir):
    """The zone tables of both services of one day, published twice from a store of all trips and read back."""
    store, folder = scratch_folder(spark, "store"), scratch_folder(spark, "tables")
    write_store(_with_month(_trips(spark, sf_dir)), store, MONTH_KEYS, sort=("trip_day",))
    for _ in range(2):
        names = publish_day(spark, store, tables.zones(spark, sf_dir), DAY, folder=folder)
    yellow, green = (run_query(spark, names[s]["zones"]).withColumn("service", F.lit(s)) for s in ("yellow", "green"))
    return yellow.unionByName(green)


@register
def day_overwrite(spark, sf_dir):
    """A store in which the green trips of each January are replaced: their amounts are doubled."""
    store = scratch_folder(spark, "store")
    trips = _with_month(_trips(spark, sf_dir)).select(*MONTH_KEYS, *tables.KEY, "trip_day", "total_amount")
    write_store(trips, store, MONTH_KEYS)
    again = trips.where("service = 'green' AND month LIKE '%-01'")
    write_store(again.withColumn("total_amount", F.col("total_amount") * 2), store, MONTH_KEYS)
    return spark.read.parquet(store).groupBy("service", "trip_day").agg(
        F.count("*").alias("trips"), F.sum("total_amount").alias("revenue")
    )


@register
def write_roundtrip(spark, sf_dir):
    path = scratch_folder(spark, "trips")
    _trips(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


@register
def append_tables(spark, sf_dir):
    """Two conversions appended to one table."""
    path = scratch_folder(spark, "converted")
    trips = _trips(spark, sf_dir).select("service", *tables.KEY, "total_amount")
    for service in ("yellow", "green"):
        append(trips.where(F.col("service") == service), path)
    copy = scratch_folder(spark, "converted")
    convert_table(spark.read.parquet(path), copy)
    return spark.read.parquet(copy)


#: Text formats repeat names and digits that a table's own formats pack by themselves.
PACKED = {"json": {"compression": "lz4"}, "csv": {"compression": "lz4"}}


@register
def convert_formats(spark, sf_dir):
    """Trips converted from one file format to the next and read back from the last."""
    trips = _trips(spark, sf_dir).select("service", *tables.KEY, "pickup_datetime", "pulocationid", "total_amount")
    table = trips
    for fmt in ("orc", "json", "csv", "parquet"):
        path = scratch_folder(spark, f"as-{fmt}")
        convert_table(table, path, fmt, **PACKED.get(fmt, {}))
        table = read_table(spark, path, fmt, trips.schema)
    return table


@register
def processed_store_kpis(spark, sf_dir):
    """Raw trips of both services through the cleaning job into a store, then the zone report from it."""
    store, zones = scratch_folder(spark, "processed"), tables.zones(spark, sf_dir)
    for service in ("yellow", "green"):
        raw_to_processed(_raw(spark, sf_dir, service), zones, service, store, "all", below=())
    return daily.zone_kpis(spark.read.parquet(store), zones)


def _published(spark: SparkSession, df: DataFrame, times: int, **how) -> DataFrame:
    """Publishes a report and reads the table back."""
    folder = scratch_folder(spark, "table")
    table = "published_" + folder[-32:]
    for _ in range(times):
        publish(df, table, folder=folder, **how)
    return run_query(spark, table)


@register
def publish_daily(spark, sf_dir):
    kpis = daily_kpis(spark, sf_dir).withColumn("month", F.date_format("date", "yyyy-MM"))
    return _published(spark, kpis, 1, replace_by=("month",))


@register
def publish_twice(spark, sf_dir):
    kpis = zone_kpis(spark, sf_dir).withColumn("year", F.year("date"))
    return _published(spark, kpis, 2, replace_by=("year",))


@register
def publish_limited(spark, sf_dir):
    """The first rows of the report, as many as the table takes."""
    kpis = zone_kpis(spark, sf_dir)
    order = ["date", "service", F.asc_nulls_first("pulocationid")]
    return _published(spark, kpis, 1, replace_by=(), limit=PUBLISHED_ROWS, order=order)


@register
def csv_roundtrip(spark, sf_dir):
    path = scratch_folder(spark, "csv")
    trips = _trips(spark, sf_dir).select(*tables.KEY, "service", "trip_day", "total_amount")
    write_csv(trips, path)
    return read_csv(spark, path, trips.schema)


@register
def lookup_csv_pinned(spark, sf_dir):
    path = scratch_folder(spark, "lookup")
    write_csv(tables.zones(spark, sf_dir), path)
    return read_zone_lookup(spark, path).select(*ZONE_LOOKUP.names)


@register
def lookup_csv_inferred(spark, sf_dir):
    path = scratch_folder(spark, "lookup")
    write_csv(tables.zones(spark, sf_dir), path)
    return read_csv(spark, path, infer=True)


@register
def recursive_scan(spark, sf_dir):
    """Trips in nested folders beside files of another kind, read back in one recursive scan and counted by folder."""
    root = scratch_folder(spark, "nested")
    trips = _trips(spark, sf_dir).withColumn("kept_service", F.col("service"))
    trips.write.partitionBy("service").parquet(f"{root}/a/b")
    write_csv(tables.zones(spark, sf_dir), f"{root}/a/lookup")
    found = read_recursive(spark, root)
    folder = F.regexp_extract("path", "/a/b/service=([a-z]+)/", 1)
    return found.groupBy(folder.alias("folder"), "kept_service").agg(
        F.count("*").alias("trips"), F.sum("total_amount").alias("revenue")
    )


@register
def latest_file_of_store(spark, sf_dir):
    """The lookup written twice, first without half of its zones; the newest file is read."""
    root, zones = scratch_folder(spark, "lookups"), tables.zones(spark, sf_dir)
    write_csv(zones.where("LocationID < 12"), f"{root}/first")
    write_csv(zones, f"{root}/second")
    return read_latest(spark, root)


#: Trips of a file of a year; a year with more is cut into parts by the trips' keys.
TRIPS_PER_FILE = 500_000


def _periods(trips: DataFrame) -> list[tuple[str, int, int]]:
    """Service, year and number of trips of every year's file."""
    counted = trips.groupBy("service", F.year("pickup_datetime").alias("period")).count()
    return [tuple(r) for r in counted.orderBy("service", "period").collect()]


def _parts(periods: list[tuple[str, int, int]]) -> int:
    """Parts into which each year is cut, so that none of its files is too long for one task."""
    return max([1, *(math.ceil(n / TRIPS_PER_FILE) for _, _, n in periods)])


def _year_files(spark, trips: DataFrame, periods: list[tuple[str, int, int]]) -> str:
    """Trips in folders by service, year of pick-up and part, one file in each."""
    parts = _parts(periods)
    root = scratch_folder(spark, "years")
    part = F.pmod(F.xxhash64(*tables.KEY), F.lit(parts))
    rows = trips.drop("trip_day").withColumns({"period": F.year("pickup_datetime"), "part": part})
    keys = ("service", "period", "part")
    rows.repartition(max(1, 2 * len(periods) * parts), *keys).write.partitionBy(*keys).parquet(root)
    return root


def _by_service_and_day(stored: DataFrame) -> DataFrame:
    return stored.groupBy("service", "trip_day").agg(F.count("*").alias("trips"), F.sum("total_amount").alias("revenue"))


@register
def ingest_overlapping_years(spark, sf_dir):
    """All trips in files by year of pick-up, ingested one after another and one of them twice, counted by drop-off."""
    store, trips = scratch_folder(spark, "raw"), _trips(spark, sf_dir)
    periods = _periods(trips)
    files = _year_files(spark, trips, periods)
    for service, period, _ in [*periods, periods[1]]:
        pattern = f"{files}/service={service}/period={period}/*/*.parquet"
        ingest_raw(spark, [pattern], store, service, "dropoff_datetime", str(period), below=())
    return _by_service_and_day(spark.read.parquet(store))


#: The year whose file comes again without its last days, and the first day that it has lost.
SHORTENED, LOST_FROM = 1996, "1996-11-16"


@register
def ingest_default_layout(spark, sf_dir):
    """The green trips in files by year, ingested into folders by service, source and day, each file a source.

    Years share the days at their turns. One year's files are ingested again, then one year comes
    again without its last weeks, whose days must go.
    """
    store, service = scratch_folder(spark, "raw"), "green"
    trips = _trips(spark, sf_dir).where(F.col("service") == service)
    periods = _periods(trips)
    files = _year_files(spark, trips, periods)
    shorter = trips.where((F.year("pickup_datetime") == SHORTENED) & (F.col("pickup_datetime") < F.lit(LOST_FROM).cast("date")))
    again = _year_files(spark, shorter, periods)
    ingest_raw(spark, [f"{files}/service={service}/*/*/*.parquet"], store, service, "dropoff_datetime", at_once=8)
    for part in range(_parts(periods)):
        (source,) = ingest_raw(spark, [f"{files}/service={service}/period={SHORTENED}/part={part}/*.parquet"], store, service, "dropoff_datetime")
        ingest_raw(spark, [f"{again}/service={service}/*/part={part}/*.parquet"], store, service, "dropoff_datetime", source)
    return _by_service_and_day(spark.read.parquet(store))


def _refreshed_partials(spark, sf_dir) -> DataFrame:
    """Partials of a store of all trips, after the green trips of one day came again with doubled amounts."""
    store, target = scratch_folder(spark, "store"), scratch_folder(spark, "partials")
    trips = _with_month(_trips(spark, sf_dir))
    for service in ("yellow", "green"):
        replace_source(trips.where(F.col("service") == service), store, service, "all", ("month",))
        refresh_partials(spark, store, target, service, "all", below=("month",))
    doubled = F.when(F.col("trip_day") == F.lit(DAY).cast("date"), F.col("total_amount") * 2).otherwise(F.col("total_amount"))
    replaced = trips.where((F.col("service") == "green") & (F.col("month") == DAY[:7])).withColumns({"total_amount": doubled, "source": F.lit("all")})
    write_store(replaced, store, (*SOURCE_KEYS, "month"))
    refresh_partials(spark, store, target, "green", "all", F.col("month") == DAY[:7], ("month",))
    return spark.read.parquet(target)


@register
def daily_kpis_from_partials(spark, sf_dir):
    return merged_daily_kpis(_refreshed_partials(spark, sf_dir))


@register
def zone_kpis_from_partials(spark, sf_dir):
    return merged_zone_kpis(_refreshed_partials(spark, sf_dir), tables.zones(spark, sf_dir))


#: From this year on, months hold codes as whole numbers and have one more column.
NEW_FORM_FROM = 1995


def _month_files(spark, raw: DataFrame, service: str, pickup: str) -> str:
    """Raw trips as months named like the files of a service; types and columns change with a year."""
    root = scratch_folder(spark, "months")
    month = F.concat(F.lit(f"{service}_tripdata_"), F.date_format(pickup, "yyyy-MM"), F.lit(".parquet"))
    named = raw.withColumn("file", month).repartition("file")
    new = F.year(pickup) >= NEW_FORM_FROM
    named.where(~new).write.partitionBy("file").parquet(f"{root}/old")
    whole = {c: F.col(c).cast("int") for c in ("passenger_count", "payment_type")}
    named.where(new).withColumns(whole).withColumn("Unnamed: 0", F.lit(0)).write.partitionBy("file").parquet(f"{root}/new")
    return root


@register
def month_files_read(spark, sf_dir):
    """Months of two schemas read as one, with service, year and month from their names."""
    root = _month_files(spark, _raw(spark, sf_dir, "yellow"), "yellow", "tpep_pickup_datetime")
    return read_month_files(spark, root, "yellow").groupBy("service", "year", "month").agg(
        F.count("*").alias("trips"), F.sum("passenger_count").alias("passengers"), F.count("Unnamed: 0").alias("in_new_form")
    )


@register
def month_files_cleaned(spark, sf_dir):
    """Months of two schemas through the cleaning into folders by month, read back whole."""
    target = scratch_folder(spark, "cleaned")
    root = _month_files(spark, _raw(spark, sf_dir, "yellow").where("payment_type IS NOT NULL"), "yellow", "tpep_pickup_datetime")
    clean_month_files(spark, root, tables.zones(spark, sf_dir), "yellow", target, "intent")
    return _local_times(spark.read.parquet(target)).drop("service", "year", "month")


@register
def month_files_augmented(spark, sf_dir):
    """Months of a service completed with ids, customers and ratings, read back whole."""
    target = scratch_folder(spark, "augmented")
    trips = _trips(spark, sf_dir).where("service = 'green'").select(*tables.KEY, "pickup_datetime", "passenger_count", F.lit(1.0).alias("payment_type"))
    root = _month_files(spark, trips, "green", "pickup_datetime")
    order = ["pickup_datetime", *tables.KEY]
    augment_month_files(spark, root, "green", tables.customers(spark, sf_dir), order, target, digest_draw, unique=True)
    return spark.read.parquet(target).select(*tables.KEY, "pickup_datetime", "id", "id_customer", "rate")


@register
def store_file_counts(spark, sf_dir):
    """A store written with a number of files: as many in each folder, whatever its size."""
    store = scratch_folder(spark, "store")
    write_store(_trips(spark, sf_dir), store, ("service",), files=STORE_FILES)
    stored = spark.read.parquet(store).select("service", F.col("_metadata.file_path").alias("file"))
    return stored.groupBy("service").agg(F.countDistinct("file").alias("files"), F.count("*").alias("trips"))


@register
def unwanted_columns_dropped(spark, sf_dir):
    """Columns that a file writer left behind go by a part of their name."""
    trips = _trips(spark, sf_dir).select(*tables.KEY, "total_amount", F.lit(1).alias("Unnamed: 0"), F.lit(2).alias("Unnamed: 0.1"))
    return drop_containing(trips, "Unnamed")


@register
def coordinates_added_once(spark, sf_dir):
    """Trips with coordinates of the pick-up keep them; those of the drop-off are looked up."""
    trips = _trips(spark, sf_dir).select(*tables.KEY, "pulocationid", "dolocationid")
    trips = trips.withColumns({"pickup_latitude": F.lit(1.5), "pickup_longitude": F.lit(2.5)})
    return add_both_coordinates(trips, small_side(tables.zones(spark, sf_dir)))


# Change stream


def _changes(spark, sf_dir):
    return tables.change_messages(_items(spark, sf_dir))


def _change_stream(spark, sf_dir):
    return tables.change_messages(tables.line_items_stream(spark, sf_dir))


def _finish(*running: StreamingQuery) -> None:
    for query in running:
        if not query.awaitTermination(STREAM_SECONDS):
            query.stop()
            raise TimeoutError("a stream did not finish")


@register
def cdc_parse(spark, sf_dir):
    return _local_times(changes.parse_changes(_changes(spark, sf_dir)))


@register
def cdc_rejects(spark, sf_dir):
    rejected = changes.rejected_changes(_changes(spark, sf_dir))
    return rejected.groupBy("reason").agg(F.count("*").alias("messages"))


@register
def cdc_encode(spark, sf_dir):
    """The messages themselves, their fields read by path and not by the parser of the stream.

    Each level of the path is read once for all its fields.
    """
    texts = [f"{name}_text" for name in GREEN_AFTER.names]
    messages = tables.whole_changes(_items(spark, sf_dir), *tables.KEY)
    payloads = messages.select(*tables.KEY, F.json_tuple("value", "payload").alias("payload"))
    images = payloads.select(*tables.KEY, F.json_tuple("payload", "op", "after").alias("op", "after"))
    fields = images.select(*tables.KEY, "op", F.json_tuple("after", *GREEN_AFTER.names).alias(*texts))
    typed = [F.col(text).cast(field.dataType).alias(field.name) for text, field in zip(texts, GREEN_AFTER)]
    return fields.select(*tables.KEY, "op", *typed)


@register
def cdc_stream_rejects(spark, sf_dir):
    """Messages that the running job could not turn into rows."""
    folder = scratch_folder(spark, "changes")
    _finish(*changes.start_ingest(_change_stream(spark, sf_dir), folder, once=True))
    return spark.read.parquet(f"{folder}/rejects").groupBy("reason").agg(F.count("*").alias("messages"))


@register
def cdc_stream_append(spark, sf_dir):
    folder = scratch_folder(spark, "changes")
    rows = changes.parse_changes(_change_stream(spark, sf_dir))
    _finish(changes.start_append(rows, f"{folder}/data", f"{folder}/checkpoint", once=True))
    return _local_times(spark.read.parquet(f"{folder}/data"))


#: Files of a replayed feed, each a trigger, and triggers between two folds of the count table.
FEED_FILES, FOLD_EVERY = 4, 2
#: Messages of a file of a feed; each of the files above is cut into as many as that takes.
MESSAGES_PER_FILE = 250_000


def _change_feed(spark, sf_dir) -> DataFrame:
    """The change messages as files, of which each trigger reads its share; an empty message becomes an empty line."""
    feed, messages = scratch_folder(spark, "feed"), _changes(spark, sf_dir)
    cuts = max(1, math.ceil(messages.count() / (FEED_FILES * MESSAGES_PER_FILE)))
    write_text_messages(messages, feed, files=FEED_FILES * cuts)
    return text_messages(spark, feed, files_per_trigger=cuts)


@register
def cdc_stream_customer_count(spark, sf_dir):
    """All queries of the job run side by side over several triggers; the counts by changed keys are returned."""
    folder = scratch_folder(spark, "changes")
    _finish(*changes.start_ingest(_change_feed(spark, sf_dir), folder, once=True, every=FOLD_EVERY))
    return changes.read_changed_counts(spark, f"{folder}/count_customer")


@register
def cdc_stream_count_table(spark, sf_dir):
    """The counts as a table that each trigger writes as a whole."""
    folder = scratch_folder(spark, "changes")
    counts = changes.running_counts(changes.parse_changes(_change_stream(spark, sf_dir)))
    _finish(changes.start_counts(counts, f"{folder}/count_customer", f"{folder}/count_checkpoint", once=True))
    return changes.read_counts(spark, f"{folder}/count_customer")


def _stopped_and_resumed(spark, sf_dir) -> str:
    """The job stopped after its first batches, wherever its queries were, and started again to the end."""
    folder, feed = scratch_folder(spark, "changes"), _change_feed(spark, sf_dir)
    running = changes.start_ingest(feed, folder, every=FOLD_EVERY)
    deadline = time.monotonic() + STREAM_SECONDS
    while not any((q.lastProgress or {}).get("batchId", -1) >= 1 for q in running):
        if time.monotonic() > deadline or not all(q.isActive for q in running):
            raise TimeoutError("a stream did not get to its second batch")
        time.sleep(0.1)
    for query in running:
        query.stop()
    _finish(*changes.start_ingest(feed, folder, once=True, every=FOLD_EVERY))
    return folder


@register
def cdc_state_after_stop(spark, sf_dir):
    """The counts in the state of the job's checkpoint, after it was stopped between batches and went on."""
    return changes.counts_in_state(spark, f"{_stopped_and_resumed(spark, sf_dir)}/count_checkpoint")


@register
def cdc_recovery_gaps(spark, sf_dir):
    """Customers on whom log, counts and state agree after the stop, and on whom they do not."""
    folder = _stopped_and_resumed(spark, sf_dir)
    gaps = changes.recovery_gaps(spark, folder)
    counted = changes.read_changed_counts(spark, f"{folder}/count_customer")
    return counted.agg(F.count("*").alias("customers"), F.sum("customer_count").alias("changes")).join(gaps.agg(F.count("*").alias("gaps")))


@register
def cdc_replay(spark, sf_dir):
    """Messages written as files and replayed share by share; an empty message becomes an empty line."""
    folder = scratch_folder(spark, "changes")
    rows = changes.parse_changes(_change_feed(spark, sf_dir))
    _finish(changes.start_append(rows, f"{folder}/data", f"{folder}/checkpoint", once=True))
    return _local_times(spark.read.parquet(f"{folder}/data"))


# Media


def _media(documents: DataFrame, kind: str = "image") -> DataFrame:
    return media.encode_media(tables.media_files(documents), kind)


def _documents(spark, sf_dir):
    return tables.given(spark, sf_dir, "documents")


@register
def media_encode(spark, sf_dir):
    return media.sendable(_media(_documents(spark, sf_dir))).select(
        "id", F.get_json_object("value", "$.image_data").alias("image_data")
    )


@register
def media_rejects(spark, sf_dir):
    return media.refused(_media(_documents(spark, sf_dir)), MEDIA_BYTES)


@register
def media_gate(spark, sf_dir):
    """Every document with the length of its message and the reason, if it is refused."""
    return media.gate(_media(_documents(spark, sf_dir)), MEDIA_BYTES)


@register
def media_gate_product(spark, sf_dir):
    """As ``media_gate`` under the bound of the product."""
    return media.gate(_media(_documents(spark, sf_dir)))


def _described(objects: DataFrame) -> DataFrame:
    return objects.select("path", "content_type", "n_bytes", F.md5("content").alias("digest"))


@register
def media_decode(spark, sf_dir):
    messages = media.sendable(_media(_documents(spark, sf_dir)))
    return _described(media.whole(media.decode_media(messages, "image")))


def _media_stream(spark, sf_dir, kind="image"):
    documents = tables.documents_stream(spark, sf_dir)
    sent = media.sendable(_media(documents, kind))
    return sent.withColumn("at", F.col("id").try_cast("long"))


@register
def media_stream_objects(spark, sf_dir):
    folder = scratch_folder(spark, "media")
    _finish(media.start_media(_media_stream(spark, sf_dir), "image", folder, "at", once=True))
    return _described(spark.read.parquet(f"{folder}/objects"))


@register
def media_stream_speech(spark, sf_dir):
    folder = scratch_folder(spark, "media")
    _finish(media.start_media(_media_stream(spark, sf_dir, "speech"), "speech", folder, "at", once=True))
    return _described(spark.read.parquet(f"{folder}/objects"))


#: Batches of a media feed, and about how long the messages of the newest objects in one of its files are.
MEDIA_BATCHES, MEDIA_FILE_BYTES = 4, 32 * 1024 * 1024


def _stored_resent(spark, sf_dir) -> str:
    """Every document sent twice, first with other content, and some broken messages, all over several batches."""
    files = tables.media_files(_documents(spark, sf_dir))
    old = files.withColumn("content", F.encode(F.concat(F.lit("old "), "id"), "UTF-8"))
    first = media.sendable(media.encode_media(old, "image")).withColumn("at", F.lit(1))
    last = media.sendable(media.encode_media(files, "image")).withColumn("at", F.lit(2))
    doc = F.col("id").cast("long")
    cut = last.where(doc % 7 == 0).withColumns({"value": F.substring("value", 1, 12), "at": F.lit(3)})
    no_base64 = F.replace("value", F.lit('"image_data":"'), F.lit('"image_data":"%'))
    wrong = last.where(doc % 11 == 0).withColumns({"value": no_base64, "at": F.lit(4)})
    sent = first.unionByName(last).unionByName(cut).unionByName(wrong).select("value", "at", "id")
    feed, folder = scratch_folder(spark, "feed"), scratch_folder(spark, "media")
    n_bytes = media.encode_media(files, "image").agg(F.sum("n_bytes")).first()[0] or 0
    cuts = max(1, math.ceil(n_bytes / (MEDIA_BATCHES * MEDIA_FILE_BYTES)))
    sent.repartition(MEDIA_BATCHES * cuts, "id", "at").write.parquet(feed)
    stream = table_stream(spark, feed, sent.schema, files_per_trigger=cuts)
    _finish(media.start_media(stream, "image", folder, "at", once=True))
    return folder


@register
def media_stream_latest(spark, sf_dir):
    """The last object of each path, although its messages fall into different batches."""
    return _described(media.read_latest_objects(spark, _stored_resent(spark, sf_dir), "at"))


@register
def media_stream_rejects(spark, sf_dir):
    rejects = media.read_rejects(spark, _stored_resent(spark, sf_dir))
    return rejects.groupBy("reason").agg(F.count("*").alias("messages"))


@register
def media_stream_files(spark, sf_dir):
    """One file per message; the files are read back as binary rows."""
    folder = scratch_folder(spark, "media")
    store = f"{qualified(spark, folder)}/store"
    running = media.start_media(
        _media_stream(spark, sf_dir), "image", folder, "at", lambda: put_object(store), once=True
    )
    _finish(running)
    return get_objects(spark, store).select("path", F.col("length").alias("n_bytes"), F.md5("content").alias("digest"))
