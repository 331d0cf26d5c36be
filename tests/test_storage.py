import os
import subprocess
import sys
from datetime import date, datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.functions.text import day_path, month_file_parts, service_type
from farelane.plans.augment import augment_month_files
from farelane.plans import daily
from farelane.plans.ingest import clean_month_files, convert_table, ingest_raw, publish_day, stored_rows
from farelane.plans.partials import day_partials, merged_daily_kpis, merged_month_to_date, merged_zone_kpis, refresh_partials
from farelane.scratch import scratch_folder
from farelane.sinks import tables
from farelane.sinks.exports import write_csv
from farelane.sinks.store import append, read_day, read_month_to_date, replace_source, shaped, with_store_keys, write_store
from farelane.sources import files
from tests.test_reports import frame as plain_frame
from tests.test_reports import trip


def frame(spark, rows, source="one"):
    return plain_frame(spark, rows).withColumn("source", F.lit(source))


@pytest.fixture
def store(spark, tmp_path):
    days = [trip(f"2024-01-{d:02} {h:02}:00", amount=float(d)) for d in range(1, 6) for h in (1, 9)]
    rows = days + [trip("2024-01-04 09:00", service="green"), trip("2023-12-31 23:55", amount=100.0)]
    path = str(tmp_path / "store")
    write_store(frame(spark, rows), path)
    return path


def test_folders_are_days_of_dropoff(store):
    assert sorted(d for d in os.listdir(f"{store}/service=yellow/source=one")) == [f"trip_day=2024-01-{d:02}" for d in range(1, 6)]
    assert os.listdir(f"{store}/service=green/source=one") == ["trip_day=2024-01-04"]


def test_day_and_month_reads(spark, store):
    first = read_day(spark, store, "yellow", "2024-01-01")
    assert first.count() == 3 and first.select("pickup_date").distinct().count() == 2
    month = read_month_to_date(spark, store, "yellow", "2024-01-03")
    assert month.agg(F.sum("total_amount")).first()[0] == 112.0
    assert read_month_to_date(spark, store, "yellow", "2024-02-03").count() == 0


def test_only_asked_folders_are_read(spark, store):
    for df, n in ((read_day(spark, store, "yellow", "2024-01-01"), 1), (read_month_to_date(spark, store, "yellow", "2024-01-03"), 3)):
        plan = df._jdf.queryExecution().toString()
        assert "PartitionFilters: [isnotnull(service" in plan
        assert df.select(F.col("_metadata.file_path")).distinct().select(F.regexp_extract("file_path", "trip_day=([^/]*)", 1)).distinct().count() == n


def test_replacing_one_day_leaves_the_others(spark, store):
    write_store(frame(spark, [trip("2024-01-02 12:00", amount=50.0)]), store)
    stored = {str(r["trip_day"]): r["s"] for r in spark.read.parquet(store).where("service = 'yellow'").groupBy("trip_day").agg(F.sum("total_amount").alias("s")).collect()}
    assert stored["2024-01-02"] == 50.0 and stored["2024-01-03"] == 6.0 and len(stored) == 5


def test_number_of_files(spark, tmp_path):
    df = frame(spark, [trip("2024-01-02 12:00", customer=c) for c in range(100)])
    write_store(df, str(tmp_path / "one"), files=1)
    assert spark.read.parquet(str(tmp_path / "one")).select("_metadata.file_path").distinct().count() == 1


def test_a_task_writes_one_file_of_one_folder(spark):
    """With a fixed number of files no task takes a share of all folders, nor its rows from a shuffle."""
    df = spark.range(3000).selectExpr("id", "IF(id % 3 = 0, 'green', 'yellow') AS service")
    rows = shaped(df, ("service",), 4)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    tasks = rows.groupBy(F.spark_partition_id()).agg(F.countDistinct("service"), F.count("*")).collect()
    assert len(tasks) == 8 and {services for _, services, _ in tasks} == {1}
    assert sorted(rows.collect()) == sorted(df.collect())


def test_fixed_files_keep_odd_rows(spark, tmp_path):
    """Null keys, rows that are all alike, values at the ends of their types, and more folders than parts."""
    alike = spark.range(400).selectExpr("1 AS a", "CAST(NULL AS STRING) AS service", "CAST('nan' AS DOUBLE) AS b", "TIMESTAMP'1066-01-02 03:04:05.678901' AS t")
    many = spark.range(4000).selectExpr("CAST(id AS INT) AS a", "CONCAT('x', id % 400) AS service", "-0.0D AS b", "CAST(NULL AS TIMESTAMP) AS t")
    df, path = alike.unionAll(many), str(tmp_path / "store")
    write_store(df, path, ("service",), files=3)
    stored = spark.read.parquet(path)
    columns = ["a", "service", F.col("b").cast("string"), F.col("t").cast("string")]
    assert stored.select(columns).exceptAll(df.select(columns)).count() == df.select(columns).exceptAll(stored.select(columns)).count() == 0
    files = stored.select("service", F.col("_metadata.file_path").alias("file")).groupBy("service").agg(F.countDistinct("file")).collect()
    assert dict(map(tuple, files))[None] == 3 and max(n for _, n in files) <= 3 and len(files) == 401


def test_fixed_files_of_no_rows(spark, tmp_path):
    df = frame(spark, [trip("2024-01-02 12:00")])
    replace_source(df, str(tmp_path / "store"), "yellow", "one", files=2)
    replace_source(df.limit(0), str(tmp_path / "store"), "yellow", "one", files=2)
    assert not [f for _, _, found in os.walk(tmp_path) for f in found if f.endswith(".parquet")]
    replace_source(df.limit(0), str(tmp_path / "whole"), "yellow", "one", below=(), files=2)
    assert spark.read.parquet(str(tmp_path / "whole")).count() == 0


def test_large_day_is_split_over_files(spark, tmp_path):
    """One day holds nearly all rows; the rebalanced write gives it several tasks."""
    df = spark.range(400_000, numPartitions=8).selectExpr(
        "'yellow' AS service", "IF(id % 50 = 0, DATE'2024-01-02', DATE'2024-01-01') AS trip_day", "id", "uuid() AS noise", "'one' AS source"
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        write_store(df, str(tmp_path / "store"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    stored = spark.read.parquet(str(tmp_path / "store"))
    assert stored.count() == 400_000 and stored.select("id").distinct().count() == 400_000
    hot = stored.where("trip_day = DATE'2024-01-01'").select("_metadata.file_path").distinct().count()
    assert hot > 2


def test_append_and_conversion(spark, tmp_path):
    df = spark.range(10)
    for _ in range(2):
        append(df, str(tmp_path / "a"))
    convert_table(files.read_table(spark, str(tmp_path / "a")), str(tmp_path / "b"))
    assert files.read_table(spark, str(tmp_path / "b"), schema=df.schema).count() == 20


def test_ingest_by_patterns(spark, tmp_path):
    for day in (1, 2):
        df = spark.createDataFrame([(datetime(2024, 1, day, 5), day)], "dropoff timestamp_ntz, v int")
        df.write.parquet(str(tmp_path / f"in/2024/01/0{day}.parquet"))
    ingest_raw(spark, [str(tmp_path / "in/2024/01/*.parquet")], str(tmp_path / "raw"), "yellow", "dropoff")
    assert {(str(r["trip_day"]), r["v"]) for r in spark.read.parquet(str(tmp_path / "raw")).collect()} == {
        ("2024-01-01", 1),
        ("2024-01-02", 2),
    }


def test_inputs_that_share_a_day_keep_their_rows(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "raw")
    months = {"01": ["2024-01-31 09:00", "2024-02-01 00:10"], "02": ["2024-02-01 08:00", "2024-02-01 09:00", "2024-02-02 10:00"]}
    for month, ends in months.items():
        rows = [(datetime.fromisoformat(end), i) for i, end in enumerate(ends)]
        spark.createDataFrame(rows, "dropoff timestamp_ntz, v int").coalesce(1).write.parquet(f"{source}/{month}")
    for month in ("01", "02", "01", "02", "01"):
        ingest_raw(spark, [f"{source}/{month}/*.parquet"], target, "yellow", "dropoff")
    days = spark.read.parquet(target).groupBy("trip_day").count().collect()
    assert {str(r["trip_day"]): r["count"] for r in days} == {"2024-01-31": 1, "2024-02-01": 3, "2024-02-02": 1}


def _trip_files(spark, root, months):
    for folder, ends in months.items():
        rows = [(datetime.fromisoformat(end), i) for i, end in enumerate(ends)]
        os.makedirs(f"{root}/{folder}", exist_ok=True)
        pq.write_table(pa.table({"dropoff": [r[0] for r in rows], "v": [r[1] for r in rows]}), f"{root}/{folder}/data.parquet")


def _stored(spark, target):
    return sorted((str(r["trip_day"]), r["v"]) for r in spark.read.parquet(target).collect())


def test_files_of_one_name_are_sources_of_their_own(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "raw")
    _trip_files(spark, source, {"2024-01": ["2024-01-31 09:00", "2024-02-01 00:10"], "2024-02": ["2024-02-01 08:00", "2024-02-02 10:00"]})
    for month in ("2024-01", "2024-02", "2024-01"):
        (name,) = ingest_raw(spark, [f"{source}/{month}/*.parquet"], target, "yellow", "dropoff")
        assert name.endswith(f"/{month}/data.parquet")
    assert _stored(spark, target) == [("2024-01-31", 0), ("2024-02-01", 0), ("2024-02-01", 1), ("2024-02-02", 1)]
    assert len(ingest_raw(spark, [f"{source}/*/*.parquet"], target, "yellow", "dropoff")) == 2
    assert len(_stored(spark, target)) == 4


def test_a_day_that_has_gone_from_a_file_goes_from_the_store(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "raw")
    _trip_files(spark, source, {"a": ["2024-01-31 09:00", "2024-02-01 00:10"], "b": ["2024-02-01 07:00"]})
    ingest_raw(spark, [f"{source}/*/*.parquet"], target, "yellow", "dropoff")
    _trip_files(spark, source, {"a": ["2024-01-31 10:00"]})
    ingest_raw(spark, [f"{source}/a/*.parquet"], target, "yellow", "dropoff")
    assert _stored(spark, target) == [("2024-01-31", 0), ("2024-02-01", 0)]


def test_odd_source_names_come_back(spark, tmp_path):
    names = ["s3a://lake/a b/2024=01/data.parquet", "100%", "ä#'\"?*:{[^]}", "2024"]
    for i, name in enumerate(names):
        replace_source(spark.range(i + 1).withColumn("trip_day", F.lit("2024-01-01")), str(tmp_path), "yellow", name)
        replace_source(spark.range(i + 1).withColumn("trip_day", F.lit("2024-01-01")), str(tmp_path), "yellow", name)
    found = spark.read.parquet(str(tmp_path)).groupBy("source").count().collect()
    assert {r["source"]: r["count"] for r in found} == {name: i + 1 for i, name in enumerate(names)}
    assert [stored_rows(spark, str(tmp_path), "yellow", name) for name in names] == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        replace_source(spark.range(1), str(tmp_path), "yellow", "")


def test_a_source_that_became_empty_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "store")
    days = frame(spark, [trip("2024-01-01 09:00"), trip("2024-01-02 09:00")])
    for source in ("one", "two"):
        replace_source(days, path, "yellow", source)
    replace_source(days.where("false"), path, "yellow", "one")
    assert {tuple(r) for r in spark.read.parquet(path).groupBy("source").count().collect()} == {("two", 2)}
    assert stored_rows(spark, path, "yellow", "one") == 0 and stored_rows(spark, path, "yellow", "two") == 2


FAILS_ONCE = """
import sys
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from farelane.sinks.store import replace_source
from farelane.plans.ingest import stored_rows

spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "3").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
failures = sys.argv[2]

def through(batches):
    yield from batches
    if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() == 1:
        open(failures, "a").write("failed ")
        raise RuntimeError("once")

rows = spark.range(1000, numPartitions=4).mapInArrow(through, "id long").withColumn("trip_day", F.lit("2024-01-01"))
replace_source(rows, sys.argv[1], "yellow", "one")
print(stored_rows(spark, sys.argv[1], "yellow", "one"))
"""


def test_counts_hold_after_a_task_ran_twice(tmp_path):
    command = [sys.executable, "-c", FAILS_ONCE, str(tmp_path / "store"), str(tmp_path / "failures")]
    done = subprocess.run(command, capture_output=True, text=True, timeout=300)
    assert done.stdout.split() == ["1000"] and (tmp_path / "failures").read_text() == "failed "


def test_publishing_refuses_other_columns_and_types(spark, tmp_path):
    report = spark.createDataFrame([(1, 2.0, "x")], "a int, v double, date string")
    publish = lambda df: tables.publish(df, "checked_table", folder=str(tmp_path / "table"))
    publish(report)
    for other in (report.withColumn("b", F.lit(1)), report.drop("v"), report.withColumn("a", F.col("a").cast("long"))):
        with pytest.raises(ValueError):
            publish(other)
    assert [tuple(r) for r in spark.table("checked_table").collect()] == [(1, 2.0, "x")]
    offered = tables.publish(report.union(report.withColumn("a", F.lit(2))), "checked_table", limit=1, order=["a"], folder=str(tmp_path / "table"))
    assert offered == {"offered": 2, "written": 1}
    spark.sql("DROP TABLE checked_table")


def test_publish_day_twice(spark, store, zones, tmp_path):
    for _ in range(2):
        names = publish_day(spark, store, zones, "2024-01-04", folder=str(tmp_path / "tables"))
    assert names["yellow"] == {"daily": "YELLOW_DAILY_MONTH_TABLE_2024_01", "zones": "YELLOW_DAILY_TABLE_2024_01_04"}
    publish_day(spark, store, zones, "2024-01-05", folder=str(tmp_path / "tables"))
    month = files.run_query(spark, names["yellow"]["daily"]).orderBy("date").collect()
    assert [(r["date"], r["revenue_of_day"], r["revenue_of_month"]) for r in month] == [
        (date(2024, 1, 4), 8.0, 120.0),
        (date(2024, 1, 5), 10.0, 130.0),
    ]
    green = files.run_query(spark, names["green"]["zones"], f"SELECT zone FROM {names['green']['zones']}")
    assert [r[0] for r in green.collect()] == ["Airport"]
    write_store(frame(spark, [trip("2024-01-03 23:55")]), store)
    publish_day(spark, store, zones, "2024-01-04", services=("yellow",), folder=str(tmp_path / "tables"))
    assert [str(r["date"]) for r in spark.table(names["yellow"]["daily"]).collect()] == ["2024-01-05"]
    for service in names.values():
        for table in service.values():
            spark.sql(f"DROP TABLE {table}")


def _shown(spark, table):
    return sorted(tuple(r) for r in spark.table(table).select("v", "k").collect())


def test_readers_see_whole_parts_while_publishing(spark, tmp_path):
    folder, frame_of = str(tmp_path / "t"), lambda rows: spark.createDataFrame(rows, "v int, k string")
    tables.publish(frame_of([(1, "a"), (2, "a"), (3, "b")]), "staged_table", ("k",), folder=folder)
    seen = [r[0] for r in spark.table("staged_table").where("k = 'a'").select("_metadata.file_path").distinct().collect()]
    staged = tables.stage_report(frame_of([(10, "a"), (20, "c's \\ %")]), "staged_table", ("k",), folder)
    assert _shown(spark, "staged_table") == [(1, "a"), (2, "a"), (3, "b")]
    tables.switch_parts(spark, staged)
    assert _shown(spark, "staged_table") == [(3, "b"), (10, "a"), (20, "c's \\ %")]
    assert sorted(r["v"] for r in spark.read.parquet(*seen).collect()) == [1, 2]
    # Switching once more changes nothing, and the files out of use since the switch before are emptied.
    tables.publish(frame_of([(10, "a"), (20, "c's \\ %")]), "staged_table", ("k",), folder=folder)
    assert _shown(spark, "staged_table") == [(3, "b"), (10, "a"), (20, "c's \\ %")]
    old = [p for p in (tmp_path / "t-parts").glob("*/k=a") if spark.read.parquet(str(p)).columns == ["cleared"]]
    assert len(old) == 1
    spark.sql("DROP TABLE staged_table")


def test_only_touched_parts_are_registered(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "t")
    tables.publish(spark.createDataFrame([(i, str(i)) for i in range(8)], "v int, k string"), "touched_table", ("k",), folder=folder)
    locations = lambda: {k: spark.sql(f"DESCRIBE TABLE EXTENDED touched_table PARTITION (k = '{k}')").where("col_name = 'Location'").first()[1] for k in range(8)}
    before = locations()
    tables.publish(spark.createDataFrame([(30, "3")], "v int, k string"), "touched_table", ("k",), folder=folder)
    after = locations()
    assert [k for k in range(8) if before[k] != after[k]] == [3]
    tables.publish(spark.createDataFrame([], "v int, k string"), "touched_table", ("k",), folder=folder)
    assert _shown(spark, "touched_table") == [(i if i != 3 else 30, str(i)) for i in (0, 1, 2, 4, 5, 6, 7)] + [(30, "3")]
    tables.publish(spark.createDataFrame([(5, None), (6, "x y")], "v int, k string"), "touched_table", ("k",), folder=folder)
    assert (5, None) in [tuple(r) for r in spark.table("touched_table").select("v", "k").collect()]
    spark.sql("DROP TABLE touched_table")


def test_whole_table_is_switched(spark, tmp_path):
    folder = str(tmp_path / "t")
    for n in (3, 2, 5):
        tables.publish(spark.range(n), "whole_table", (), folder=folder)
        assert spark.table("whole_table").count() == n
    spark.sql("DROP TABLE whole_table")


def test_limited_table(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "DATE'2024-01-01' AS date")
    with pytest.raises(ValueError):
        tables.publish(df, "limited", limit=5)
    tables.publish(df, "limited", limit=5, order=[F.desc("id")], folder=str(tmp_path / "t"))
    assert sorted(r["id"] for r in spark.table("limited").collect()) == [95, 96, 97, 98, 99]
    tables.publish(df.select("date", "id"), "limited", folder=str(tmp_path / "t"))
    assert spark.table("limited").agg(F.sum("id")).first()[0] == 4950
    spark.sql("DROP TABLE limited")


def test_warehouse_types():
    schema = T.StructType(
        [
            T.StructField("a", T.LongType(), False),
            T.StructField("b", T.TimestampNTZType()),
            T.StructField("c", T.DoubleType()),
        ]
    )
    assert tables.warehouse_schema(schema) == [
        {"name": "a", "field_type": "INT64", "mode": "REQUIRED"},
        {"name": "b", "field_type": "DATETIME", "mode": "NULLABLE"},
        {"name": "c", "field_type": "FLOAT64", "mode": "NULLABLE"},
    ]
    with pytest.raises(TypeError, match="column d"):
        tables.warehouse_schema(T.StructType([T.StructField("d", T.ArrayType(T.LongType()))]))


def test_relational_statement_and_options():
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("t", T.StringType())])
    assert tables.relational_statement("trips", schema) == "CREATE TABLE trips (id BIGINT, x DOUBLE PRECISION, t TEXT)"
    options = tables.relational_options("jdbc:postgresql://h/db", "trips")
    assert options["batchsize"] == "10000" and options["dbtable"] == "trips"


def test_csv_readers(spark, zones, tmp_path):
    path = str(tmp_path / "zones")
    write_csv(zones.withColumn("Unnamed: 0", F.lit(1)), path, files=1)
    assert {t for _, t in files.read_csv(spark, path).dtypes} == {"string"}
    assert dict(files.read_csv(spark, path, infer=True).dtypes)["latitude"] == "double"
    pinned = files.read_zone_lookup(spark, path)
    assert pinned.schema.simpleString() == zones.schema.simpleString()
    assert sorted(pinned.collect()) == sorted(zones.collect())


def test_listing_and_latest(spark, tmp_path):
    for n, name in enumerate(["2023/a.parquet", "2024/b.csv", "2024/c.csv"]):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(f"x,y\n{n},1\n")
        os.utime(path, (1000 + n, 1000 + n))
    root = str(tmp_path)
    assert [r["path"].split("/")[-1] for r in files.list_files(spark, root).collect()] == ["a.parquet"]
    assert files.list_files(spark, root, ".csv", prefix="2024").count() == 2
    assert files.list_files(spark, root, ".csv", prefix="2024/c").count() == 1
    assert files.list_files(spark, root, ".csv", prefix="20").count() == 2
    assert files.read_latest(spark, root).first()["x"] == 2
    os.utime(tmp_path / "2024/b.csv", (9000, 9000))
    assert files.read_latest(spark, root).first()["x"] == 1
    with pytest.raises(ValueError):
        files.read_latest(spark, root, ".txt")
    with pytest.raises(FileNotFoundError):
        files.read_latest(spark, str(tmp_path / "2023"), ".csv")


def month_file(folder, name, n, start):
    at = [start + timedelta(minutes=i) for i in range(n)]
    table = pa.table(
        {
            "lpep_pickup_datetime": pa.array(at, pa.timestamp("us")),
            "lpep_dropoff_datetime": pa.array(at, pa.timestamp("us")),
            "PULocationID": pa.array([1 + i % 3 for i in range(n)], pa.int32()),
            "DOLocationID": pa.array([2] * n, pa.int32()),
            "ehail_fee": pa.array([None] * n, pa.float64()),
            "Key": pa.array(range(n), pa.int64()),
        }
    )
    pq.write_table(table, folder / name)


@pytest.fixture
def months(tmp_path):
    folder = tmp_path / "months"
    (folder / "2023").mkdir(parents=True)
    month_file(folder / "2023", "green_tripdata_2023-12.parquet", 40, datetime(2023, 12, 5))
    month_file(folder, "green_tripdata_2024-01.parquet", 60, datetime(2024, 1, 5))
    month_file(folder, "yellow_tripdata_2024-01.parquet", 5, datetime(2024, 1, 5))
    return str(folder)


def test_month_files(spark, months):
    rows = files.read_month_files(spark, months, "green").groupBy("service", "year", "month").count().collect()
    assert {tuple(r) for r in rows} == {("green", "2024", "01", 60), ("green", "2023", "12", 40)}
    parts = month_file_parts(F.lit("/x/other.parquet"))
    assert spark.range(1).select(parts["service"]).first()[0] == ""


def test_months_of_other_types_and_columns(spark, tmp_path):
    pq.write_table(pa.table({"Fee": pa.array([1, 2], pa.int64())}), tmp_path / "green_tripdata_2024-01.parquet")
    other = {"fee": pa.array([0.5, None], pa.float64()), "Extra": pa.array(["x", "y"])}
    pq.write_table(pa.table(other), tmp_path / "green_tripdata_2024-02.parquet")
    rows = files.read_month_files(spark, str(tmp_path), "green")
    found = sorted(((r["month"], r["Fee"], r["Extra"]) for r in rows.collect()), key=repr)
    assert found == [("01", 1.0, None), ("01", 2.0, None), ("02", 0.5, "x"), ("02", None, "y")]
    with pytest.raises(FileNotFoundError):
        files.read_month_files(spark, str(tmp_path), "yellow")


def test_augmented_month_files(spark, months, tmp_path):
    target = str(tmp_path / "augmented")
    augment_month_files(spark, months, "green", spark.range(5), ["lpep_pickup_datetime", "Key"], target)
    rows = spark.read.parquet(target)
    assert "ehail_fee" not in rows.columns and rows.count() == 100
    january = sorted((r["Key"], r["id"]) for r in rows.where("month = 1").collect())
    assert january == [(n, f"202401{n + 1:08}") for n in range(60)]
    assert {r["id_customer"] for r in rows.collect()} <= set(range(5))
    assert all(1 <= r["rate"] <= 5 for r in rows.collect())


def test_cleaned_month_files(spark, months, zones, tmp_path):
    target = str(tmp_path / "cleaned")
    clean_month_files(spark, months, zones, "green", target)
    assert os.listdir(target) in ([], ["_SUCCESS"]) or spark.read.parquet(target).count() == 0
    clean_month_files(spark, months, zones, "green", target, "intent")
    rows = spark.read.parquet(target).groupBy("year", "month").count().collect()
    assert {tuple(r) for r in rows} == {(2024, 1, 40), (2023, 12, 27)}


def test_paths_and_service(spark):
    row = spark.range(1).select(
        day_path("data/green", F.lit(date(2024, 1, 2))), service_type(F.lit("a/yellow/b")), service_type(F.lit("x"))
    )
    assert tuple(row.first()) == ("data/green/2024/01/02", 1, None)


class Settings:
    def __init__(self, **values):
        self.conf = self
        self.values = values

    def get(self, name, default=None):
        return self.values.get(name.replace(".", "_"), default)


def test_scratch_follows_the_session(spark):
    assert "/numbers-" in scratch_folder(spark, "numbers")
    assert scratch_folder(Settings(spark_checkpoint_dir="/shared/folder/"), "x").startswith("/shared/folder/x-")
    with pytest.raises(RuntimeError):
        scratch_folder(Settings(spark_master="yarn"), "x")


def test_store_keys(spark):
    df = frame(spark, [trip("2024-01-01 23:55")]).drop("trip_day", "service")
    assert tuple(with_store_keys(df, "green").select("service", "trip_day").first()) == ("green", date(2024, 1, 2))


def test_partials_follow_replaced_days(spark, zones, tmp_path):
    path, target = str(tmp_path / "store"), str(tmp_path / "partials")
    january = [trip(f"2024-01-{d:02} {h:02}:00", amount=float(d), customer=h) for d in range(1, 6) for h in (1, 9, 23)]
    late = [trip("2024-01-05 23:55", amount=7.0), trip("2024-01-06 00:10", amount=9.0)]
    for name, rows in (("one", january), ("two", late)):
        replace_source(frame(spark, rows), path, "yellow", name)
        refresh_partials(spark, path, target, "yellow", name)

    def same():
        trips, partials = spark.read.parquet(path), spark.read.parquet(target)
        assert sorted(map(repr, merged_daily_kpis(partials).collect())) == sorted(map(repr, daily.daily_kpis(trips).collect()))
        for how in ("left", "inner"):
            ours, theirs = merged_zone_kpis(partials, zones, how), daily.zone_kpis(trips, zones, how)
            assert sorted(map(repr, ours.collect())) == sorted(map(repr, theirs.collect()))
        month = merged_month_to_date(partials, "yellow", "2024-01-05").first()
        assert month == daily.month_to_date_revenue(trips, "yellow", "2024-01-05").first()

    same()
    day = F.col("trip_day") == F.lit("2024-01-03").cast("date")
    again = frame(spark, [trip("2024-01-03 12:00", amount=50.0)])
    write_store(again.withColumns({"service": F.lit("yellow"), "source": F.lit("one")}), path)
    before = {f for f in os.listdir(f"{target}/service=yellow/source=one")}
    files_before = {d: sorted(os.listdir(f"{target}/service=yellow/source=one/{d}")) for d in before if d.startswith("trip_day")}
    refresh_partials(spark, path, target, "yellow", "one", day)
    same()
    changed = [d for d in files_before if sorted(os.listdir(f"{target}/service=yellow/source=one/{d}")) != files_before[d]]
    assert changed == ["trip_day=2024-01-03"]
    # Days that have gone with their input go from the partials too, and so does a whole source.
    replace_source(frame(spark, january[:6]), path, "yellow", "one")
    refresh_partials(spark, path, target, "yellow", "one")
    same()
    replace_source(frame(spark, late).where("false"), path, "yellow", "two")
    refresh_partials(spark, path, target, "yellow", "two")
    same()


def test_a_refresh_reads_the_replaced_days_only(spark, store):
    stored = spark.read.parquet(store).where((F.col("service") == "yellow") & (F.col("source") == "one"))
    partials = day_partials(stored.where("trip_day = DATE'2024-01-02'"))
    plan = partials._jdf.queryExecution().executedPlan().toString()
    assert "trip_day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    files = stored.where("trip_day = DATE'2024-01-02'").select("_metadata.file_path").distinct().collect()
    assert {r[0].split("trip_day=")[1].split("/")[0] for r in files} == {"2024-01-02"}
