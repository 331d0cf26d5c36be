"""Connected components of a graph given as pairs, by alternating stars.

Every round hangs each node on the smallest node next to it: first the larger
neighbours, then the smaller. Neighbours are never collected, only their minimum, so a
node with a third of all pairs costs no more than others. Each round is written, which
keeps lineage short and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import saved

MAX_ROUNDS = 60


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(pairs: DataFrame) -> DataFrame:
    down = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of pairs a, b; no pairs give no rows.

    Repeated pairs, pairs of a node with itself and both directions are allowed; pairs
    with a null are ignored.
    """
    pairs = saved(pairs.select("a", "b").filter("a != b").distinct(), "pairs")
    before = None
    for _ in range(MAX_ROUNDS):
        pairs = saved(_small_star(_large_star(pairs).filter("a != b")), "stars")
        now = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = pairs.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
