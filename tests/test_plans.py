"""What the plans of the registered queries must and must not contain."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from farelane.operators.augment import add_customers

SF_DIR = "/root/testdata/sf0.001"
REPORTS = [
    "daily_kpis",
    "daily_kpis_one_day",
    "daily_kpis_joined_form",
    "month_to_date_revenue",
    "revenue_running_month",
    "zone_kpis",
    "zone_kpis_known_only",
    "zone_kpis_one_day",
    "part_of_day_mix",
    "calendar_mix",
    "clean_trips_strict",
    "clean_trips_strict_green",
    "clean_trips_intent",
    "clean_trips_intent_green",
    "clean_audit",
    "all_trips_cleaned",
    "fact_rollup_all",
    "top_customers",
    "top_customer_trips",
    "top_customer_habits",
    "top_customer_habits_each",
    "customer_habits",
    "customer_habits_ranked",
    "customer_totals",
    "customer_profile",
    "customer_profile_one",
    "trips_with_rating",
    "customer_id_collisions",
    "trip_sample",
    "cdc_parse",
    "cdc_rejects",
    "media_encode",
    "media_rejects",
    "media_decode",
]


def explained(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.mark.parametrize("name", REPORTS)
def test_no_cross_join_no_python_no_whole_window(spark, name):
    plan = explained(queries()[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEvalPython"):
        assert node not in plan
    if "Window" in plan:
        assert "hashpartitioning" in plan


# The JVM does not compile methods beyond this size.
COMPILED_BYTES = 8000


@pytest.mark.parametrize("name", REPORTS)
def test_generated_methods_stay_small_enough_to_be_compiled(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = re.findall(r"maxMethodCodeSize:(\d+)", explained(queries()[name](spark, SF_DIR), "codegen"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sizes and max(map(int, sizes)) < COMPILED_BYTES


def scans(plan):
    """Columns read from line items by each scan."""
    return [set(re.findall(r"(l_\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<([^\n]*)>", plan) if "l_" in schema]


def exchanges(plan):
    return len(re.findall(r"\n\(\d+\) Exchange", plan))


@pytest.mark.parametrize(
    "name, n_scans, n_shuffles",
    [
        ("daily_kpis", 1, 2),
        ("zone_kpis", 1, 1),
        ("customer_totals", 1, 1),
        ("customer_profile", 1, 2),
        ("top_customer_habits", 2, 3),
        ("clean_trips_strict", 1, 0),
        ("trip_sample", 1, 0),
        ("cdc_parse", 1, 0),
    ],
)
def test_scans_and_shuffles(spark, name, n_scans, n_shuffles):
    plan = explained(queries()[name](spark, SF_DIR))
    assert len(scans(plan)) == n_scans
    assert exchanges(plan) == n_shuffles


def test_counting_customers_reads_one_column(spark):
    assert scans(explained(queries()["top_customers"](spark, SF_DIR))) == [{"l_partkey"}]


def test_habits_are_counted_for_top_customers_only(spark):
    plan = explained(queries()["top_customer_habits"](spark, SF_DIR))
    assert "TakeOrderedAndProject" in plan and "LeftSemi" in plan
    assert {"l_partkey"} in scans(plan)


def test_filters_reach_the_scan(spark):
    assert "EqualTo(l_partkey,151)" in explained(queries()["customer_profile_one"](spark, SF_DIR))
    assert "GreaterThanOrEqual(l_shipdate" in explained(queries()["daily_kpis_one_day"](spark, SF_DIR))


def test_refused_messages_are_found_without_encoding(spark):
    assert "base64" not in explained(queries()["media_rejects"](spark, SF_DIR))


def test_messages_are_parsed_once(spark):
    assert explained(queries()["cdc_parse"](spark, SF_DIR)).count("from_json") == 1


def test_customer_list_is_broadcast_after_its_size_check(spark):
    """A list of 15,000 customers moves no trip."""
    trips = spark.range(600_000).withColumnRenamed("id", "trip")
    listed = spark.range(15_000).selectExpr("CAST(id AS string) AS id")
    plan = explained(add_customers(trips, listed, F.xxhash64("trip")))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
