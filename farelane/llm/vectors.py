"""What both searches share: valid vectors, waves of queries, running and merged top lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import saved

#: Queries compared in one pass over the candidates; they and their lists fit into a task.
WAVE = 4096
#: Top lists merged at a time.
FAN_IN = 16

TOP_DDL = "query_id long, task long, vec_ids array<long>, scores array<{score}>"


def valid_vectors(embeddings: DataFrame, zero: bool = True) -> DataFrame:
    """vec_id, vec (doubles) of rows with an id and a whole, finite vector of the usual length.

    The usual length is the one of most vectors, the longer on a tie. Empty vectors, and
    zero vectors unless ``zero``, are left out.
    """
    vec = F.col("vec")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & (F.size(vec) > 0) & finite)
    if not zero:
        rows = rows.filter(F.exists(vec, lambda x: x != 0))
    lengths = rows.groupBy(F.size(vec).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size(vec) == (lengths["n"] if lengths else 0))


def query_rows(vectors: DataFrame, chosen: Column) -> DataFrame:
    """One query per id; an id with several vectors asks with the smallest."""
    return vectors.filter(chosen).groupBy("vec_id").agg(F.min("vec").alias("vec"))


def waves(queries: DataFrame) -> Iterator[DataFrame]:
    """The queries in parts of about WAVE rows, by a hash of their id; each part fits into a broadcast."""
    parts = queries.count() // WAVE + 1
    for part in range(parts):
        yield queries.filter(F.pmod(F.xxhash64("vec_id"), parts) == part)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as rows of doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


class TopLists:
    """The best k so far of every query: highest score first, ties to the smaller id."""

    def __init__(self, queries: int, k: int, dtype=np.float64):
        self.k = k
        self.ids = [np.zeros(0, np.int64)] * queries
        self.scores = [np.zeros(0, dtype)] * queries

    def add(self, query: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate([self.ids[query], ids]), np.concatenate([self.scores[query], scores])
        if len(ids) > self.k:
            least = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            near = scores >= least
            ids, scores = ids[near], scores[near]
        order = np.lexsort((ids, -scores))[: self.k]
        self.ids[query], self.scores[query] = ids[order], scores[order]

    def floor(self, query: int) -> float:
        """A score below this cannot enter the list."""
        return self.scores[query][-1] if len(self.scores[query]) == self.k else -np.inf

    def batch(self, query_ids: np.ndarray, task: int, kind: pa.DataType) -> pa.RecordBatch:
        full = [i for i, ids in enumerate(self.ids) if len(ids)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(query_ids[full], pa.int64()),
                pa.array(np.full(len(full), task), pa.int64()),
                pa.array([self.ids[i] for i in full], pa.list_(pa.int64())),
                pa.array([self.scores[i] for i in full], pa.list_(kind)),
            ],
            names=["query_id", "task", "vec_ids", "scores"],
        )


def merged_lists(lists: DataFrame, tasks: int, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the tasks' lists merged as a tree, FAN_IN at a time."""
    pairs = F.transform(F.arrays_zip("scores", "vec_ids"), lambda p: F.struct((-p["scores"]).alias("s"), p["vec_ids"].alias("v")))
    tops = lists.select("query_id", "task", pairs.alias("top"))
    while tasks > 1:
        tasks = (tasks - 1) // FAN_IN + 1
        group = F.floor(F.col("task") / FAN_IN) if tasks > 1 else F.lit(0).cast("long")
        best = F.slice(F.sort_array(F.flatten(F.collect_list("top"))), 1, k)
        tops = tops.groupBy("query_id", group.alias("task")).agg(best.alias("top"))
    ranked = tops.select("query_id", F.posexplode("top").alias("place", "p"))
    return ranked.select("query_id", (F.col("place") + 1).alias("rank"), F.col("p.v").alias("vec_id"), (-F.col("p.s")).alias("score"))


def searched(parts: Iterator[DataFrame]) -> DataFrame:
    """The result of every wave, each written before the next begins."""
    found = None
    for part in parts:
        part = saved(part, "top-lists")
        found = part if found is None else found.union(part)
    return found
