"""Most frequent values and top rows.

Everything is counted first, with partial sums before each shuffle, so a key
that holds a third of the rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from farelane.operators.numbering import number_rows


def first_by_count(count: Column | str, *values: str) -> Column:
    """Aggregate: the values with the highest count, ties to the smallest values.

    A struct with ``negated`` (minus the count) in front; rows whose count is
    null take no part.
    """
    count = F.col(count) if isinstance(count, str) else count
    ranked = F.struct((-count).alias("negated"), *values)
    return F.min(F.when(count.isNotNull(), ranked))


def top_rows(df: DataFrame, by: list[str], order: list[Column], n: int = 1, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group, numbered; Spark trims groups before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn(rank, place).where(F.col(rank) <= n)


def top_k(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """``k`` rows under a total order; no full sort."""
    return df.orderBy(*order).limit(k)


#: Rows that one task sorts for a sample; a larger sample is cut out by a threshold.
SMALL_SAMPLE = 100_000
#: Ranks of ``percentile_approx`` are right within one in so many rows.
QUANTILES = 10_000


def sample_exact(df: DataFrame, n: int, draw: Column, *key: str, small: int = SMALL_SAMPLE) -> DataFrame:
    """``n`` random rows, the same ones at every run: those of the smallest draws, ties by ``key``.

    A large sample takes all rows below a quantile of the draws in one filter pass. Only the rows
    between this quantile and one just above place ``n`` are numbered, by a range sort, so no
    task sees the sample.
    """
    if n <= small:
        return df.orderBy(draw, *key).limit(n)
    drawn = df.withColumn("_draw", draw)
    total = drawn.count()
    if n >= total:
        return df
    share, slack = n / total, 3 / QUANTILES
    around = F.array(F.lit(max(share - slack, 0.0)), F.lit(min(share + slack, 1.0)))
    low, high = drawn.agg(F.percentile_approx("_draw", around, QUANTILES)).first()[0]
    below, until = drawn.agg(F.count_if(F.col("_draw") < low), F.count_if(F.col("_draw") <= high)).first()
    # Quantiles are approximate: one that missed place n is not used.
    under = F.col("_draw") < low if below <= n else F.lit(False)
    over = F.col("_draw") > high if until >= n else F.lit(False)
    edge = drawn.where(~under & ~over)
    edge = number_rows(edge, "_place", ["_draw", *key]).where(F.col("_place") <= n - (below if below <= n else 0))
    return drawn.where(under).select(*df.columns).unionByName(edge.select(*df.columns))


#: Candidates that a sketch names beyond the places asked for, and values that it tracks.
SPARE_CANDIDATES, TRACKED = 100, 100_000


def top_by_sketch(df: DataFrame, key: str, k: int, count: str, tracked: int = TRACKED) -> tuple[DataFrame, bool]:
    """The ``k`` most frequent values of ``key`` with their exact counts, and whether the sketch settled them.

    A bounded sketch, merged over tasks, names candidates; these alone are counted again. A
    value that it does not name occurs at most ``7 * rows / tracked`` times (twice the sketch's
    error) or as often as its last candidate. If place ``k`` counts more than that, no other
    value can reach it, not even in a tie; else all values are counted. Null is a value.
    Ties go to the smaller value, null first.
    """
    spark, wanted = df.sparkSession, min(k + SPARE_CANDIDATES, tracked)
    seen = df.agg(F.expr(f"approx_top_k(`{key}`, {wanted}, {tracked})").alias("top"), F.count("*").alias("n")).first()
    kind = StructType([StructField("_value", df.schema[key].dataType)])
    candidates = spark.createDataFrame([(item["item"],) for item in seen["top"]], kind)
    counted = df.join(F.broadcast(candidates), F.col(key).eqNullSafe(F.col("_value")), "left_semi").groupBy(key).agg(F.count("*").alias(count))
    counts = sorted((r[count] for r in counted.collect()), reverse=True)
    outside = max(7 * seen["n"] / tracked, seen["top"][-1]["count"] if len(seen["top"]) == wanted else 0)
    settled = sum(counts) == seen["n"] or (len(counts) >= k and counts[k - 1] > outside)
    every = counted if settled else df.groupBy(key).agg(F.count("*").alias(count))
    return top_k(every, k, F.desc(count), key), settled
