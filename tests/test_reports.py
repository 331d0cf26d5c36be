"""Daily, zone and customer reports on hand-made rows and against plain Python."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from farelane.functions.calendar import part_of_day
from workload.glued import daily_tables_glued
from farelane.plans import customers as people
from farelane.plans import daily
from farelane.plans.rollup import fact_rollup

SCHEMA = (
    "service string, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, pulocationid int, "
    "id_customer long, total_amount double, tip_amount double, fare_amount double, trip_distance double, "
    "passenger_count double, tolls_amount double, congestion_surcharge double"
)


def trip(start, minutes=10, zone=1, customer=1, amount=8.0, service="yellow"):
    start = datetime.fromisoformat(start)
    return (service, start, start + timedelta(minutes=minutes), zone, customer, amount) + (1.0,) * 6


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("trip_day", F.to_date("dropoff_datetime"))


def test_day_counts_its_own_pickups_and_month_counts_all(spark):
    trips = frame(
        spark,
        [
            trip("2024-01-31 10:00", amount=100.0),
            trip("2024-01-31 23:55", amount=4.0),
            trip("2024-02-01 10:00", amount=8.0),
            trip("2024-02-03 10:00", amount=16.0),
            trip("2024-02-03 10:00", amount=64.0, service="green"),
        ],
    )
    rows = {(r["service"], str(r["date"])): r for r in daily.daily_kpis(trips).collect()}
    assert len(rows) == 4
    first = rows["yellow", "2024-02-01"]
    assert (first["revenue_of_day"], first["revenue_of_month"], first["avg_trip_time"]) == (8.0, 12.0, 10.0)
    assert rows["yellow", "2024-02-03"]["revenue_of_month"] == 28.0
    assert rows["green", "2024-02-03"]["revenue_of_month"] == 64.0


def test_day_without_pickups_gives_no_row(spark):
    trips = frame(spark, [trip("2024-01-31 23:55")])
    assert daily.daily_kpis_on(trips, "yellow", "2024-02-01").count() == 0
    assert daily.daily_kpis_on(trips, "yellow", "2024-02-02").count() == 0
    assert daily.month_to_date_revenue(trips, "yellow", "2024-03-01").first()[0] is None


def test_one_pass_equals_glued_tables(spark):
    trips = frame(spark, [trip(f"2024-02-{d:02} {h:02}:30", 45, amount=float(d * h)) for d in range(1, 10) for h in range(24)])
    one = daily.daily_kpis_on(trips, "yellow", "2024-02-07").collect()
    assert one == daily_tables_glued(trips, "yellow", "2024-02-07").collect() and len(one) == 1


def test_zone_report_keeps_unknown_and_missing_zones(spark, zones):
    trips = frame(spark, [trip("2024-01-01 10:00", zone=z) for z in (1, 1, 99, None)])
    rows = {r["pulocationid"]: r for r in daily.zone_kpis(trips, zones).collect()}
    assert rows[1]["zone"] == "Airport" and rows[1]["total_trip_count"] == 2
    assert rows[99]["zone"] is None and rows[99]["total_trip_count"] == 1
    assert rows[None]["total_trip_count"] == 0 and rows[None]["total_amount"] == 8.0
    assert daily.zone_kpis(trips, zones, how="inner").count() == 1


@pytest.mark.parametrize(
    "hour, label",
    [(0, "Đêm"), (4, "Đêm"), (5, "Sáng"), (11, "Sáng"), (12, "Chiều"), (17, "Chiều"), (18, "Tối"), (22, "Tối"), (23, "Đêm")],
)
def test_part_of_day(spark, hour, label):
    at = F.make_timestamp(F.lit(2024), F.lit(1), F.lit(1), F.lit(hour), F.lit(59), F.lit(59))
    assert spark.range(1).select(part_of_day(at)).first()[0] == label


def test_part_of_day_of_missing_time(spark):
    assert spark.range(1).select(part_of_day(F.lit(None).cast("timestamp"))).first()[0] == "Đêm"


def random_trips(n, seed=1):
    """One customer and one zone hold about a third of all trips."""
    rng = random.Random(seed)
    for _ in range(n):
        customer = 7 if rng.random() < 0.34 else rng.randint(1, 40)
        zone = 1 if rng.random() < 0.34 else rng.choice([1, 2, 3, None])
        start = datetime(2024, 1, 1) + timedelta(minutes=rng.randint(0, 40_000))
        yield trip(start.isoformat(), rng.randint(1, 90), zone, customer, rng.randint(1, 400) / 4)


DAY_PARTS = {**{h: "Sáng" for h in range(5, 12)}, **{h: "Chiều" for h in range(12, 18)}, **{h: "Tối" for h in range(18, 23)}}


def usual(values):
    """Most frequent value, ties to the smallest, missing first."""
    def rank(item):
        value, n = item
        parts = value if isinstance(value, tuple) else (value,)
        return (-n, [(p is not None, p if p is not None else 0) for p in parts])

    return min(Counter(values).items(), key=rank)


def test_habits_and_profiles_against_plain_python(spark, zones):
    rows = list(random_trips(3000))
    trips = frame(spark, rows)
    by_customer = {}
    for row in rows:
        by_customer.setdefault(row[4], []).append(row)
    habits = {r["id_customer"]: r for r in people.customer_habits(trips).collect()}
    each = {r["id_customer"]: r for r in people.customer_habits_each(trips).collect()}
    profiles = {r["customerID"]: r for r in people.customer_profiles(trips, zones).collect()}
    names = {1: "Airport", 2: "Centre"}
    for customer, own in by_customer.items():
        keys = [(r[1].strftime("%A"), DAY_PARTS.get(r[1].hour, "Đêm"), r[3]) for r in own]
        joint, _ = usual(keys)
        assert tuple(habits[customer])[1:] == (len(own), *joint)
        assert tuple(each[customer])[1:] == (len(own), *[usual([k[i] for k in keys])[0] for i in range(3)])
        zone, n = usual([r[3] for r in own])
        if zone not in names:
            assert customer not in profiles
            continue
        profile = profiles[customer]
        spent = sum(r[5] for r in own)
        assert (profile["count"], profile["trip_count"], profile["zone"]) == (n, len(own), names[zone])
        assert (profile["total_spent"], profile["avg_spent"]) == (spent, spent / len(own))
        assert profile["pickup_time_of_day"] == usual([k[1] for k in keys])[0]
    ranked = {r["id_customer"]: tuple(r)[1:4] for r in people.ranked_habits(trips).collect()}
    assert ranked == {c: tuple(r)[2:] for c, r in habits.items()}


def test_top_customers_break_ties_by_id_and_ignore_nobody(spark, zones):
    rows = [trip("2024-01-01 10:00", customer=c) for c in (3, 3, 1, 1, 2, None, None, None)]
    trips = frame(spark, rows)
    assert [tuple(r) for r in people.top_customers(trips, 3).collect()] == [(None, 3), (1, 2), (3, 2)]
    top = people.top_customer_habits(trips, zones, 2)
    assert [r["customerID"] for r in top.collect()] == [1]
    assert people.trips_of(trips, people.top_customers(trips, 2)).count() == 2


def test_unknown_customer(spark, zones):
    trips = frame(spark, [trip("2024-01-01 10:00")])
    assert people.customer_profile(trips, zones, 1).count() == 1
    assert people.customer_profile(trips, zones, 999).count() == 0


def test_rollup_service_type(spark):
    extra = ["vendorid", "ratecodeid", "dolocationid", "payment_type"]
    coordinates = ["pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude"]
    other = ["extra", "mta_tax", "improvement_surcharge"]
    trips = frame(spark, [trip("2024-01-01 10:00", amount=a) for a in (1.0, 2.0)]).selectExpr(
        "*", *[f"1 AS {c}" for c in extra], *[f"CAST(1 AS DOUBLE) AS {c}" for c in coordinates + other]
    )
    for name, kind in (("data/yellow/x", 1), ("green_2024", 2), ("other", None)):
        row = fact_rollup(trips, name).first()
        assert (row["service_type"], row["total_amount"], row["month"], row["dow"]) == (kind, 3.0, "Jan", "Monday")
