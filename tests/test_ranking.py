"""Heavy hitters by sketch and large exact samples against plain counting and sorting."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from farelane.functions.draws import hash_draw
from farelane.operators.ranking import sample_exact, top_by_sketch
from farelane.sources.files import schemas_alike


def _top(values, k):
    return sorted(Counter(values).items(), key=lambda x: (-x[1], x[0] is not None, x[0]))[:k]


def _customers(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id_customer long").repartition(5)


def test_customers_that_stand_out_are_settled_by_the_sketch(spark):
    """Five customers, one of them unknown, hold half of the trips; 20,000 others have one or two each."""
    values = [v for v, n in ((7, 9000), (None, 8000), (3, 8000), (9, 4000), (1, 4000)) for _ in range(n)] + list(range(100, 20_100)) + list(range(100, 9_000))
    top, settled = top_by_sketch(_customers(spark, values), "id_customer", 5, "trips", tracked=1000)
    assert settled and [tuple(r) for r in top.collect()] == _top(values, 5)


def test_a_tie_at_the_last_place_that_the_bound_leaves_open(spark):
    """Many customers share the count of place k, the smaller ids hidden among them: all are counted."""
    values = [5] * 500 + [v for v in range(10, 3010) for _ in range(4)]
    top, settled = top_by_sketch(_customers(spark, values), "id_customer", 3, "trips", tracked=100)
    assert not settled and [tuple(r) for r in top.collect()] == [(5, 500), (10, 4), (11, 4)]


def test_a_tie_at_the_last_place_above_the_bound(spark):
    values = [5] * 3000 + [8] * 2000 + [4] * 2000 + [6] * 2000 + list(range(100, 1100))
    top, settled = top_by_sketch(_customers(spark, values), "id_customer", 2, "trips", tracked=5000)
    assert settled and [tuple(r) for r in top.collect()] == [(5, 3000), (4, 2000)]


@pytest.mark.parametrize("values, k", [([], 3), ([None], 3), ([1, 1, 2], 5)])
def test_few_values(spark, values, k):
    top, settled = top_by_sketch(_customers(spark, values), "id_customer", k, "trips")
    assert settled and [tuple(r) for r in top.collect()] == _top(values, k)


@pytest.mark.parametrize("n", [0, 1, 1000, 6667, 19_999, 20_000, 30_000])
def test_large_samples_are_those_of_the_smallest_draws(spark, n):
    df = spark.range(20_000, numPartitions=6).withColumn("noise", F.md5(F.col("id").cast("string")))
    ours = sample_exact(df, n, hash_draw("id"), "id", small=0)
    assert ours.columns == df.columns
    assert sorted(r["id"] for r in ours.collect()) == sorted(r["id"] for r in df.orderBy(hash_draw("id"), "id").limit(n).collect())


def test_copies_fill_a_sample_exactly(spark):
    """A third of all rows have one key and thus one draw, at the boundary or not."""
    df = spark.range(9000, numPartitions=6).selectExpr("IF(id % 3 = 0, 1, id) AS id")
    for n in (2000, 3001, 4500, 8000):
        ours = sorted(r["id"] for r in sample_exact(df, n, hash_draw("id"), "id", small=0).collect())
        assert ours == sorted(r["id"] for r in df.orderBy(hash_draw("id"), "id").limit(n).collect())


def test_no_task_sees_a_large_sample(spark):
    df = spark.range(60_000, numPartitions=6)
    ours = sample_exact(df, 20_000, hash_draw("id"), "id", small=0)
    plan = ours._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "GlobalLimit" not in plan and "SinglePartition" not in plan


def test_footers_are_merged_in_few_jobs(spark, tmp_path):
    kinds = ["int"] * 5 + ["double"] * 6 + ["int"] * 2
    paths = []
    for i, kind in enumerate(kinds):
        paths.append(str(tmp_path / f"{i:02}"))
        spark.range(1).select(F.col("id").cast(kind).alias("a"), F.lit(1).alias(f"only_{i % 2}")).write.parquet(paths[-1])
    runs = schemas_alike(spark, paths)
    assert [p for _, group in runs for p in group] == paths
    assert {s["a"].dataType.simpleString() for s, _ in runs} == {"int", "double"}
    for schema, group in runs:
        assert all(kinds[paths.index(p)] == schema["a"].dataType.simpleString() for p in group)
    (whole,) = schemas_alike(spark, paths[:5])
    assert whole[0].names == ["a", "only_0", "only_1"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        schemas_alike(spark, [str(tmp_path / "none")])
