import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from farelane.functions.draws import DRAW_RANGE, digest_draw, hash_draw, rating
from farelane.functions.text import zero_fill
from farelane.operators.augment import add_customers, add_rating, add_trip_ids, ensure_customer, normalize_customers
from farelane.operators.lookups import colliding, fits_broadcast, not_colliding, small_side
from farelane.operators import numbering
from farelane.operators.numbering import number_rows
from farelane.operators.ranking import sample_exact


def test_numbers_have_no_gaps_in_any_group(spark):
    """One group holds a third of the rows, and a third of all rows are copies."""
    df = spark.range(9000, numPartitions=7).selectExpr(
        "IF(id % 3 = 0, 'hot', IF(id % 7 = 0, NULL, CAST(id % 11 AS STRING))) AS g",
        "IF(id % 3 = 1, 5, id) AS v",
    )
    numbered = number_rows(df, "n", ["v"], within=["g"])
    sizes = df.groupBy("g").count().collect()
    checks = numbered.groupBy("g").agg(F.min("n"), F.max("n"), F.countDistinct("n"), F.count("*")).collect()
    assert {r["g"]: (1, r["count"], r["count"], r["count"]) for r in sizes} == {r[0]: tuple(r)[1:] for r in checks}
    rows = sorted(numbered.where("g = 'hot'").collect(), key=lambda r: r["n"])
    assert [r["v"] for r in rows] == sorted(r["v"] for r in rows)
    assert numbered.columns == ["g", "v", "n"]


def test_copies_are_spread_over_ranges(spark, tmp_path):
    copies = spark.range(0, 20_000, numPartitions=8).selectExpr("1 AS v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = number_rows(copies, "n", ["v"], folder=str(tmp_path / "numbered"))
        assert numbered.agg(F.max("n"), F.countDistinct("n")).first() == (20_000, 20_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    written = spark.read.parquet(str(tmp_path / "numbered"))
    ranges = written.groupBy(F.shiftright("_place", 33)).count().collect()
    assert len(ranges) > 1 and max(r["count"] for r in ranges) < 10_000


@pytest.mark.parametrize("within", [[], ["g"], ["g", "h"]])
@pytest.mark.parametrize("per_range", [1, 40, 100_000])
def test_numbers_by_bounds(spark, monkeypatch, within, per_range):
    """Unique keys over many ranges, with nulls, a hot group and columns beside the key."""
    monkeypatch.setattr(numbering, "ROWS_PER_RANGE", per_range)
    df = spark.range(900, numPartitions=5).selectExpr(
        "IF(id % 3 = 0, 'hot', IF(id % 7 = 0, NULL, CAST(id % 11 AS STRING))) AS g", "id % 2 AS h",
        "IF(id < 400, NULL, TIMESTAMP'2024-01-01' + make_interval(0, 0, 0, 0, 0, id % 5)) AS at", "-id AS v", "uuid() AS payload",
    )
    df = df.drop("payload").withColumn("payload", F.md5(F.col("v").cast("string")))
    numbered = number_rows(df, "n", ["at", "v"], within, unique=True)
    assert numbered.columns == [*df.columns, "n"]
    expected = df.withColumn("n", F.row_number().over(Window.partitionBy(*within).orderBy("at", "v")))
    assert sorted(map(repr, numbered.collect())) == sorted(map(repr, expected.collect()))
    assert number_rows(df.where("v > 0"), "n", ["at", "v"], within, unique=True).count() == 0


def test_ranges_of_odd_keys(spark, monkeypatch):
    """Every type of key in Spark's order: null first, NaN last, zeros alike, text by bytes; other types are bisected."""
    monkeypatch.setattr(numbering, "ROWS_PER_RANGE", 9)
    df = spark.range(240, numPartitions=5).selectExpr(
        "id AS v", "CASE id % 6 WHEN 0 THEN NULL WHEN 1 THEN double('NaN') WHEN 2 THEN -0.0D WHEN 3 THEN 0.0D WHEN 4 THEN double('Infinity') ELSE -id END AS x",
        "CASE id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '\uffee' WHEN 3 THEN '\U0001F600' ELSE 'Z' END AS s",
        "CAST(id % 7 AS DECIMAL(12, 3)) AS d", "id % 2 = 0 AS b", "unhex(hex(id % 9)) AS raw", "DATE'2024-01-01' + CAST(id % 4 AS INT) AS day",
        "IF(id % 3 = 0, NULL, TIMESTAMP'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, id % 8)) AS at", "array(id % 4, -id) AS other",
    )
    for order in (["x", "v"], ["s", "v"], ["d", "b", "v"], ["raw", "day", "v"], ["at", "s", "x", "v"], ["other", "v"]):
        numbered = number_rows(df.select(*order), "n", order, unique=True)
        expected = df.select(*order).withColumn("n", F.row_number().over(Window.orderBy(*order)))
        assert sorted(map(repr, numbered.collect())) == sorted(map(repr, expected.collect()))


def test_ranges_are_found_once_a_row_and_pass(spark, monkeypatch):
    monkeypatch.setattr(numbering, "ROWS_PER_RANGE", 1000)
    df = spark.range(20_000, numPartitions=4).selectExpr("id % 3 AS g", "id AS v")
    numbered = number_rows(df, "n", ["v"], ["g"], unique=True)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert plan.count("find(") >= 1 and plan.count("+- ArrowEvalPython") + plan.count(" ArrowEvalPython") <= 2 and "aggregate(" not in plan
    assert numbered.where("n <> 1 + v div 3").count() == 0


def test_other_columns_are_shuffled_once_and_not_written(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(numbering, "ROWS_PER_RANGE", 1000)
    folders = []
    monkeypatch.setattr(numbering, "scratch_folder", lambda spark, label: folders.append(str(tmp_path / label)) or folders[-1])
    df = spark.range(20_000, numPartitions=4).selectExpr("id AS v", "uuid() AS payload")
    numbered = number_rows(df, "n", ["v"], unique=True)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning" in line for line in plan.splitlines()) == 1 and "rangepartitioning" not in plan
    assert numbered.where("n <> v + 1").count() == 0
    assert [f.rsplit("/", 1)[1] for f in folders] == ["bounds", "range-starts"]
    assert not any("payload" in spark.read.parquet(f).columns for f in folders)
    sizes = numbered.groupBy(F.floor((F.col("n") - 1) / 1000)).count()
    assert sizes.count() == 20
    starts = [r["_before"] for r in spark.read.parquet(folders[1]).orderBy("_before").collect()]
    assert len(starts) > 15 and max(b - a for a, b in zip(starts, [*starts[1:], 20_000])) < 3000


def test_numbers_without_groups_and_without_rows(spark):
    df = spark.range(100).withColumnRenamed("id", "v")
    assert {r["v"]: r["n"] for r in number_rows(df, "n", ["v"]).collect()} == {v: v + 1 for v in range(100)}
    assert number_rows(df.where("v < 0"), "n", ["v"]).count() == 0


def test_trip_ids(spark):
    df = spark.createDataFrame([("2024", "01", 5), ("2024", "01", 3), ("2024", "02", 9)], "year string, month string, at int")
    ids = {r["at"]: r["id"] for r in add_trip_ids(df, ["at"]).collect()}
    assert ids == {3: "20240100000001", 5: "20240100000002", 9: "20240200000001"}


def test_zero_fill_never_cuts(spark):
    df = spark.createDataFrame([("7",), ("123456789",)], "v string")
    assert [r[0] for r in df.select(zero_fill(F.col("v"), 8)).collect()] == ["00000007", "123456789"]


def test_customers_are_drawn_uniformly(spark):
    trips = spark.range(20_000).withColumnRenamed("id", "trip")
    customers = spark.range(100, 110)
    given = add_customers(trips, customers, hash_draw("trip"))
    counts = {r["id_customer"]: r["count"] for r in given.groupBy("id_customer").count().collect()}
    assert set(counts) == set(range(100, 110)) and sum(counts.values()) == 20_000
    assert all(1800 < n < 2200 for n in counts.values())
    again = add_customers(trips.repartition(5), customers, hash_draw("trip"))
    assert sorted(given.collect()) == sorted(again.collect())
    with pytest.raises(ValueError):
        add_customers(trips, customers.where("id < 0"), hash_draw("trip"))


@pytest.mark.parametrize("draw", [hash_draw, digest_draw])
def test_draws_and_ratings(spark, draw):
    df = spark.range(20_000).select(draw("id").alias("d"))
    low, high = df.agg(F.min("d"), F.max("d")).first()
    assert 0 <= low < DRAW_RANGE * 0.01 and DRAW_RANGE * 0.99 < high < DRAW_RANGE
    rates = add_rating(df, F.col("d")).groupBy("rate").count().collect()
    assert {r["rate"] for r in rates} == {k / 10 for k in range(10, 51)}
    edge = spark.range(1).select(rating(F.lit(0)), rating(F.lit(DRAW_RANGE - 1))).first()
    assert tuple(edge) == (1.0, 5.0)


def test_missing_customers_are_drawn_only_if_absent(spark):
    df = spark.range(500)
    drawn = ensure_customer(df, 10, hash_draw("id"))
    assert drawn.agg(F.min("id_customer"), F.max("id_customer")).first() == (1, 10)
    assert ensure_customer(drawn, 3, hash_draw("id")) is drawn


def test_customer_ids(spark):
    df = spark.createDataFrame([(7, "Ann", "x")], "id int, firstname string, kind string")
    out = normalize_customers(df)
    assert out.columns == ["id", "kind"] and out.first()["id"] == "00000007"


def test_collisions_look_at_values(spark):
    left = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "id string")
    right = spark.createDataFrame([("c",), ("c",), ("d",)], "id string")
    assert [r[0] for r in colliding(left, right).collect()] == ["c", "c"]
    assert sorted(r[0] for r in not_colliding(left, right).collect()) == ["a", "b"]


def test_sample_has_its_size_and_does_not_depend_on_partitions(spark):
    df = spark.range(5000)
    one = sample_exact(df, 100, hash_draw("id"), "id").collect()
    two = sample_exact(df.repartition(7), 100, hash_draw("id"), "id").collect()
    assert one == two and len(one) == 100


def test_broadcast_only_below_both_bounds(spark):
    df = spark.range(100).selectExpr("id", "repeat('x', 100) AS t")
    assert fits_broadcast(df)
    assert not fits_broadcast(df, rows=99)
    assert not fits_broadcast(df, n_bytes=5000)
    assert small_side(df, rows=99) is df
