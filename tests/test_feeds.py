"""Feeds, year files and conversions at small bounds: every file stays short and the results are the same."""

from glob import glob

import pytest
from pyspark.sql import functions as F

from workload import queries, tables
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Line items of three years and some documents, one of them long."""
    root = tmp_path_factory.mktemp("given")
    spark.range(1, 901).selectExpr(
        "id div 3 AS l_orderkey", "id % 40 AS l_partkey", "id % 11 AS l_suppkey", "CAST(id % 3 AS INT) AS l_linenumber",
        "double(id % 50) AS l_quantity", "id * 1.25D AS l_extendedprice", "0.05D AS l_discount", "0.02D AS l_tax",
        "IF(id % 2 = 0, 'R', 'N') AS l_returnflag", "'F' AS l_linestatus",
        "TIMESTAMP_NTZ'1995-06-01' + make_dt_interval(CAST(id % 900 AS INT)) AS l_shipdate",
    ).write.parquet(f"{root}/lineitem.parquet")
    documents = spark.range(1, 121).selectExpr("id AS doc_id", "repeat(concat('word ', id, ' '), IF(id = 9, 2000, 20)) AS text")
    documents.write.parquet(f"{root}/documents.parquet")
    return str(root)


@pytest.fixture
def made(monkeypatch):
    """The scratch folders by label."""
    found, own = {}, queries.scratch_folder
    monkeypatch.setattr(queries, "scratch_folder", lambda spark, label: found.setdefault(label, own(spark, label)))
    return found


def same_rows(one, other):
    return sorted(map(repr, one.collect())) == sorted(map(repr, other.collect()))


@pytest.mark.parametrize("name", ["cdc_stream_customer_count", "cdc_replay", "cdc_recovery_gaps", "cdc_state_after_stop"])
def test_feed_of_many_messages_has_more_files(spark, folder, monkeypatch, made, name):
    wanted = QUERIES[name](spark, folder).collect()
    made.clear()
    monkeypatch.setattr(queries, "MESSAGES_PER_FILE", 25)
    found = QUERIES[name](spark, folder)
    assert sorted(map(repr, wanted)) == sorted(map(repr, found.collect()))
    lines = spark.read.text(made["feed"]).groupBy(F.col("_metadata.file_path")).count().collect()
    assert sum(r["count"] for r in lines) == 450 and len(lines) == 20 and max(r["count"] for r in lines) < 50


def test_feed_is_read_in_as_many_triggers(spark, folder, monkeypatch, tmp_path):
    monkeypatch.setattr(queries, "MESSAGES_PER_FILE", 25)
    feed = queries._change_feed(spark, folder).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/checkpoint")
    running = feed.trigger(availableNow=True).start(f"{tmp_path}/out")
    assert running.awaitTermination(120) and running.lastProgress["batchId"] == queries.FEED_FILES - 1


@pytest.mark.parametrize("name", ["ingest_overlapping_years", "ingest_default_layout"])
def test_long_years_are_cut_into_files(spark, folder, monkeypatch, name):
    trips = tables.trips(tables.given(spark, folder, "lineitem"))
    wanted = QUERIES[name](spark, folder).collect()
    monkeypatch.setattr(queries, "TRIPS_PER_FILE", 40)
    assert sorted(map(repr, wanted)) == sorted(map(repr, QUERIES[name](spark, folder).collect()))
    files = queries._year_files(spark, trips, queries._periods(trips))
    rows = spark.read.parquet(files).groupBy("service", "period", "part").agg(F.count("*").alias("n"), F.countDistinct("_metadata.file_path").alias("files")).collect()
    assert max(r["n"] for r in rows) < 60 and {r["files"] for r in rows} == {1} and sum(r["n"] for r in rows) == 900


def test_fields_are_read_level_by_level(spark, folder):
    found = QUERIES["cdc_encode"](spark, folder)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate json_tuple(") == 3 and "get_json_object" not in plan
    messages = tables.whole_changes(tables.given(spark, folder, "lineitem"), *tables.KEY)
    names = found.columns[len(tables.KEY) + 1 :]
    by_path = messages.select(
        *tables.KEY, F.get_json_object("value", "$.payload.op").alias("op"),
        *[F.get_json_object("value", f"$.payload.after.{n}").cast(found.schema[n].dataType).alias(n) for n in names],
    )
    assert same_rows(found, by_path) and found.schema == by_path.schema


def test_text_formats_are_packed(spark, folder, monkeypatch, made):
    found = QUERIES["convert_formats"](spark, folder)
    assert found.count() == 900
    for fmt in ("json", "csv"):
        names = glob(f"{made[f'as-{fmt}']}/part-*")
        assert names and all(name.endswith(f".{fmt}.lz4") for name in names)


@pytest.mark.parametrize("name", ["media_stream_latest", "media_stream_rejects"])
def test_media_feed_has_files_by_bytes(spark, folder, monkeypatch, made, name):
    wanted = QUERIES[name](spark, folder).collect()
    made.clear()
    monkeypatch.setattr(queries, "MEDIA_FILE_BYTES", 4000)
    found = QUERIES[name](spark, folder).collect()
    assert sorted(map(repr, wanted)) == sorted(map(repr, found))
    assert spark.read.parquet(made["feed"]).select("_metadata.file_path").distinct().count() > 8
