"""Exact top-k search by integer inner products: tiles of queries and shards.

Queries come in waves that fit into a broadcast, candidates stream by as shards. Each
tile is one matrix product of a block of queries and a shard; its best scores enter the
task's list of each query. The tasks' lists are merged as a tree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import in_slices, mapped
from farelane.llm.vectors import TOP_DDL, TopLists, matrix, merged_lists, query_rows, searched, valid_vectors, waves

SCALE = 1024
BLOCK, SHARD = 512, 2048
#: Whole numbers up to here are exact as doubles.
EXACT = float(1 << 53)


def products(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers held as doubles."""
    most = np.abs(queries).max(initial=0) * np.abs(shard).max(initial=0) * queries.shape[1]
    if most < EXACT:
        return (queries @ shard.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in shard.tolist()]
    asked = [[int(x) for x in row] for row in queries.tolist()]
    exact = [[sum(a * b for a, b in zip(q, c)) for c in whole] for q in asked]
    return np.array(exact, dtype=object).astype(np.int64)


def tile(tops: TopLists, first: int, query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, shard: np.ndarray) -> None:
    """Adds the best of one tile to the lists of its queries."""
    scores = products(queries, shard)
    k = min(tops.k, len(ids))
    # One id more than k: the query itself may be among them.
    least = np.partition(scores, len(ids) - min(k + 1, len(ids)), axis=1)[:, len(ids) - min(k + 1, len(ids))]
    for i, query_id in enumerate(query_ids.tolist()):
        bound = max(int(least[i]), int(tops.scores[first + i][-1]) if len(tops.scores[first + i]) == tops.k else int(least[i]))
        near = np.flatnonzero(scores[i] >= bound)
        near = near[ids[near] != query_id]
        if len(near) < k and (ids == query_id).sum() > 1:
            near = np.flatnonzero(ids != query_id)  # the query's id fills several rows
        if len(near):
            tops.add(first + i, ids[near], scores[i, near])


def top_k(embeddings: DataFrame, chosen: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest products of every chosen row with all other ids.

    Components are floor(1024 * x). Rows without an id, vectors that are null, empty,
    hold a null or a non-finite component, or have another length than most take no part.
    All rows of the query's id are its own. Repeated rows of an id are candidates each;
    as a query an id asks once. Ties go to the smaller vec_id. Products beyond 64 bits
    fail. No other row, or an empty table, gives no rows.
    """
    vectors = valid_vectors(embeddings)
    quantised = vectors.select("vec_id", F.transform("vec", lambda x: F.floor(x * SCALE).cast("double")).alias("vec"))
    spark = embeddings.sparkSession
    tasks = quantised.rdd.getNumPartitions()

    def wave(part: DataFrame) -> DataFrame:
        table = part.toArrow().combine_chunks()
        ids = table.column("vec_id").to_numpy()
        shared = spark.sparkContext.broadcast((ids, matrix(_array(table.column("vec")))))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            query_ids, queries = shared.value
            tops = TopLists(len(query_ids), k, np.int64)
            for batch in in_slices(batches, SHARD):
                found, shard = batch.column(0).to_numpy(), matrix(batch.column(1))
                for first in range(0, len(query_ids), BLOCK):
                    block = slice(first, first + BLOCK)
                    tile(tops, first, query_ids[block], queries[block], found, shard)
            yield tops.batch(query_ids, TaskContext.get().partitionId(), pa.int64())

        lists = mapped(quantised, run, TOP_DDL.format(score="long"))
        return merged_lists(lists, tasks, k)

    return searched(wave(part) for part in waves(query_rows(quantised, chosen)))


def _array(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
