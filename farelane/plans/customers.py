"""Reports per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.functions.calendar import with_habit_codes, with_habit_names
from farelane.functions.measures import total
from farelane.operators.lookups import add_zone_names
from farelane.operators.ranking import first_by_count, top_by_sketch, top_k, top_rows

# Names and order of the habit and zone columns.
HABITS = ("pickup_day", "pickup_time_of_day", "pulocationid")
ZONE_NAMES = ("zone", "service_zone")


def trip_counts(trips: DataFrame) -> DataFrame:
    return trips.groupBy("id_customer").agg(F.count("*").alias("trip_count"))


def top_customers(trips: DataFrame, k: int) -> DataFrame:
    """The ``k`` customers with most trips, ties to the smaller id."""
    return top_k(trip_counts(trips), k, F.desc("trip_count"), "id_customer")


def top_customers_by_sketch(trips: DataFrame, k: int) -> DataFrame:
    """As ``top_customers``: where few customers stand out, only these are counted."""
    return top_by_sketch(trips.select("id_customer"), "id_customer", k, "trip_count")[0]


def trips_of(trips: DataFrame, customers: DataFrame) -> DataFrame:
    """Trips of the listed customers, each once."""
    return trips.join(customers.select("id_customer"), "id_customer", "left_semi")


def habit_counts(trips: DataFrame) -> DataFrame:
    """Trips per customer, weekday, part of day and zone; days and parts as codes, which sort as their names do."""
    return with_habit_codes(trips).groupBy("id_customer", *HABITS).agg(F.count("*").alias("trips"))


def customer_habits(trips: DataFrame) -> DataFrame:
    """For each customer the trip count and the most frequent combination of weekday, part of day and zone."""
    best = habit_counts(trips).groupBy("id_customer").agg(
        F.sum("trips").alias("trip_count"), first_by_count("trips", *HABITS).alias("habit")
    )
    return with_habit_names(best.select("id_customer", "trip_count", *[f"habit.{name}" for name in HABITS]))


def customer_habits_each(trips: DataFrame) -> DataFrame:
    """As ``customer_habits``, but the most frequent value of each column on its own."""
    marked = with_habit_codes(trips)
    counts = marked.groupingSets(
        [["id_customer", name] for name in HABITS], "id_customer", *HABITS
    ).agg(F.count("*").alias("trips"), *[F.grouping(name).alias(f"_without_{name}") for name in HABITS])

    def of(name: str):
        return F.when(F.col(f"_without_{name}") == 0, F.col("trips"))

    best = counts.groupBy("id_customer").agg(
        F.sum(of(HABITS[0])).alias("trip_count"), *[first_by_count(of(name), name).alias(name) for name in HABITS]
    )
    return with_habit_names(
        best.select("id_customer", "trip_count", *[F.col(f"{name}.{name}").alias(name) for name in HABITS])
    )


def ranked_habits(trips: DataFrame, n: int = 1) -> DataFrame:
    """The ``n`` most frequent combinations of each customer, numbered."""
    order = [F.desc("trips"), *[F.asc(name) for name in HABITS]]
    return with_habit_names(top_rows(habit_counts(trips), ["id_customer"], order, n))


def top_customer_habits(trips: DataFrame, zones: DataFrame, k: int, mode: str = "joint") -> DataFrame:
    """Habits of the ``k`` customers with most trips, with the names of the zone.

    Two scans: the first reads the customer alone, the second counts habits for
    ``k`` customers only, so neither shuffles more than counts. Trips without a
    customer take part in the ranking but give no row, nor does a customer whose
    usual zone is unknown.
    """
    theirs = trips_of(trips, top_customers(trips, k))
    habits = customer_habits(theirs) if mode == "joint" else customer_habits_each(theirs)
    return add_zone_names(habits, zones, "pulocationid", ZONE_NAMES, "inner").select(
        F.col("id_customer").alias("customerID"),
        "pickup_day",
        "pickup_time_of_day",
        F.col("pulocationid").alias("LocationID"),
        *ZONE_NAMES,
    )


def customer_totals(trips: DataFrame) -> DataFrame:
    """Trips, spending and tips of each customer."""
    return trips.groupBy("id_customer").agg(
        F.count("*").alias("trip_count"),
        total("total_amount").alias("total_spent"),
        F.avg("total_amount").alias("avg_spent"),
        total("tip_amount").alias("total_tip"),
        F.avg("tip_amount").alias("avg_tip"),
    )


def customer_profiles(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Totals, usual zone and usual part of day of every customer, in one pass.

    Counting sets give the trips per zone and per part of day side by side;
    totals add up over the zone rows. ``count`` is the number of trips from the
    usual zone. Customers whose usual zone is unknown give no row.
    """
    counts = with_habit_codes(trips.where("id_customer IS NOT NULL")).groupingSets(
        [["id_customer", "pulocationid"], ["id_customer", "pickup_time_of_day"]],
        "id_customer",
        "pulocationid",
        "pickup_time_of_day",
    ).agg(
        F.grouping("pulocationid").alias("_without_zone"),
        F.count("*").alias("trips"),
        F.sum("total_amount").alias("spent"),
        F.count("total_amount").alias("spent_n"),
        F.sum("tip_amount").alias("tips"),
        F.count("tip_amount").alias("tips_n"),
    )
    by_zone = F.col("_without_zone") == 0

    def over_zones(name: str):
        return F.sum(F.when(by_zone, F.col(name)))

    people = counts.groupBy("id_customer").agg(
        over_zones("trips").alias("trip_count"),
        over_zones("spent").cast("double").alias("total_spent"),
        F.try_divide(over_zones("spent").cast("double"), over_zones("spent_n")).alias("avg_spent"),
        over_zones("tips").cast("double").alias("total_tip"),
        F.try_divide(over_zones("tips").cast("double"), over_zones("tips_n")).alias("avg_tip"),
        first_by_count(F.when(by_zone, F.col("trips")), "pulocationid").alias("usual"),
        first_by_count(F.when(~by_zone, F.col("trips")), "pickup_time_of_day").alias("part"),
    )
    flat = people.select(
        F.col("id_customer").alias("customerID"),
        (-F.col("usual.negated")).alias("count"),
        "trip_count",
        "total_spent",
        "avg_spent",
        "total_tip",
        "avg_tip",
        F.col("usual.pulocationid").alias("LocationID"),
        F.col("part.pickup_time_of_day").alias("pickup_time_of_day"),
    )
    return add_zone_names(with_habit_names(flat), zones, "LocationID", ZONE_NAMES, "inner").select(
        *flat.columns[:8], *ZONE_NAMES, "pickup_time_of_day"
    )


def customer_profile(trips: DataFrame, zones: DataFrame, id_customer: int) -> DataFrame:
    """One customer; the filter reaches the scan. An unknown customer gives no row."""
    return customer_profiles(trips.where(F.col("id_customer") == id_customer), zones)
