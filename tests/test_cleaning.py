import math
from datetime import datetime

import pytest

from farelane.operators.columns import drop_incomplete, lower_case_names
from farelane.plans.cleaning import clean_trips, cleaning_audit
from farelane.plans.ingest import raw_to_processed

AT = datetime(2024, 1, 2, 23, 50)
SCHEMA = (
    "VendorID double, lpep_pickup_datetime timestamp, lpep_dropoff_datetime timestamp, store_and_fwd_flag string, "
    "PULocationID int, DOLocationID int, payment_type double, trip_type double, total_amount double"
)
GOOD = (1.0, AT, AT, None, 1, 2, 3.0, 1.0, 10.0)


def with_changes(**changes):
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    row = dict(zip(names, GOOD)) | changes
    return tuple(row[name] for name in names)


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def kept(df):
    return sorted(row["total_amount"] for row in df.collect())


def test_names_types_and_order(spark, zones):
    out = clean_trips(raw(spark, GOOD), zones, "green")
    assert out.columns == sorted(out.columns)
    assert "store_and_fwd_flag" not in out.columns and "trip_type" not in out.columns
    assert dict(out.dtypes)["payment_type"] == dict(out.dtypes)["vendorid"] == "int"
    row = out.first()
    assert (row["pickup_latitude"], row["dropoff_longitude"]) == (40.0, -73.0)


def test_null_policies(spark, zones):
    rows = raw(
        spark,
        with_changes(total_amount=1.0),
        with_changes(total_amount=2.0, payment_type=None),
        with_changes(total_amount=3.0, trip_type=None),
        with_changes(total_amount=4.0, payment_type=math.nan),
        with_changes(total_amount=5.0, PULocationID=99),
        with_changes(total_amount=math.nan),
        with_changes(total_amount=7.0, store_and_fwd_flag="Y"),
    )
    assert kept(clean_trips(rows, zones, "green")) == [1.0, 7.0]
    intent = clean_trips(rows, zones, "green", "intent")
    assert kept(intent) == [1.0, 2.0, 3.0, 4.0, 7.0]
    assert {r["total_amount"]: r["payment_type"] for r in intent.collect()}[2.0] == 0
    assert kept(clean_trips(rows, zones, "green", how="inner")) == [1.0, 7.0]


def test_a_lookup_too_large_to_broadcast_gives_the_same(spark, zones, monkeypatch):
    rows = raw(spark, *[with_changes(total_amount=float(n), PULocationID=1 if n % 3 else n) for n in range(200)])
    expected = kept(clean_trips(rows, zones, "green"))
    monkeypatch.setattr("farelane.operators.lookups.fits_broadcast", lambda *_: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cleaned = clean_trips(rows, zones, "green")
        assert "SortMergeJoin" in cleaned._jdf.queryExecution().toString()
        assert kept(cleaned) == expected and len(expected) > 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_values_that_do_not_fit_a_code_drop_the_row(spark, zones):
    rows = raw(spark, with_changes(VendorID=1e30), with_changes(total_amount=2.0))
    assert kept(clean_trips(rows, zones, "green")) == [2.0]


def test_coordinates_already_there_are_kept(spark, zones):
    rows = raw(spark, GOOD).selectExpr("*", "1.5 AS pickup_latitude", "2.5 AS pickup_longitude")
    assert float(clean_trips(rows, zones, "green").first()["pickup_latitude"]) == 1.5


def test_yellow_loses_its_fee(spark, zones):
    schema = (
        "VendorID double, tpep_pickup_datetime string, tpep_dropoff_datetime string, PULocationID double, "
        "DOLocationID double, Airport_fee double, total_amount double"
    )
    rows = [
        (1.0, "2024-01-02 03:04:05", "2024-01-02 04:04:05", 1.0, 2.0, 1.25, 1.0),
        (1.0, "2024-01-02 03:04:05", "2024-01-02 04:04:05", 1.0, 2.0, None, 2.0),
    ]
    df = spark.createDataFrame(rows, schema)
    strict = clean_trips(df, zones, "yellow")
    assert "fee" not in strict.columns and dict(strict.dtypes)["pickup_datetime"] == "timestamp"
    assert kept(strict) == [1.0]
    assert kept(clean_trips(df, zones, "yellow", "intent")) == [1.0, 2.0]


def test_unknown_policy(spark, zones):
    with pytest.raises(ValueError):
        clean_trips(raw(spark, GOOD), zones, "green", "loose")


def test_same_name_in_two_cases(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(ValueError, match="vendorid"):
            lower_case_names(spark.createDataFrame([(1, 2)], "VendorID int, vendorid int"))
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_drop_incomplete_equals_dropna(spark):
    rows = [(1.0, "a"), (None, "b"), (math.nan, "c"), (math.inf, "d"), (-math.inf, None), (-math.inf, "e")]
    df = spark.createDataFrame(rows, "x double, y string")
    assert drop_incomplete(df).collect() == df.dropna().collect()


def test_audit_counts(spark, zones):
    rows = raw(
        spark,
        GOOD,
        with_changes(payment_type=None),
        with_changes(PULocationID=99),
        with_changes(DOLocationID=99),
        with_changes(PULocationID=None),
    )
    row = cleaning_audit(rows, zones, "green").first()
    assert row["rows_in"] == 5 and row["rows_out"] == clean_trips(rows, zones, "green").count() == 1
    assert (row["missing_value"], row["missing_payment_type"]) == (2, 1)
    assert (row["unknown_pickup_zone"], row["unknown_dropoff_zone"]) == (1, 1)


def test_job_counts_rows_and_can_be_repeated(spark, zones, tmp_path):
    rows = raw(spark, GOOD, with_changes(payment_type=None))
    for _ in range(2):
        assert raw_to_processed(rows, zones, "green", str(tmp_path / "store"), "2024-01") == {"before": 2, "after": 1}
    stored = spark.read.parquet(str(tmp_path / "store"))
    assert stored.count() == 1 and str(stored.first()["trip_day"]) == "2024-01-02"
