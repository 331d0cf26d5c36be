"""Approximate nearest neighbours by inner product: probed lists, scanned dimension by dimension.

Centroids of a sample cut the vectors into lists. Vectors are rotated at random and kept
in blocks of columns. A query scans its nearest lists: after each block the partial
distance is an estimate of the whole one, and a candidate is abandoned as soon as a test
says that it cannot beat the query's k-th best. What is left is scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import in_slices, mapped, saved
from farelane.llm.vectors import TOP_DDL, TopLists, matrix, merged_lists, query_rows, searched, valid_vectors, waves

#: Rows that fit centroids and the number of probed lists, about so many, chosen by a hash of their id.
FIT_ROWS = 8192
TRIED_QUERIES = 256
#: Share of the sample's true neighbours that probed lists must hold.
COVERAGE = 0.97
MAX_LISTS = 1024
KMEANS_ROUNDS = 8
#: Columns per block, and the doubt of the test: larger abandons fewer candidates.
COLUMNS, DOUBT = 16, 2.1
#: Rounding of 32-bit blocks, as a share of both squared lengths.
ROUNDING = 1e-5
#: Vectors gathered by list before they are packed, rows of a list compared and pairs scored at a time.
GATHERED, SCANNED, PAIRS = 1 << 16, 1 << 12, 1 << 15


@dataclass
class Model:
    rotation: np.ndarray
    centroids: np.ndarray
    sample: np.ndarray
    sample_ids: np.ndarray
    probes: int


def _directions(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def fit(sample: np.ndarray, ids: np.ndarray, total: int, k: int) -> Model:
    """Rotation, centroids and number of probes from a sample; the same sample gives the same model.

    The queries that set the number of probes are spread over the sample's ids, one row each.
    """
    random, dims = np.random.default_rng(7), sample.shape[1]
    rotation = np.linalg.qr(random.standard_normal((dims, dims)))[0]
    lists = int(np.clip(np.sqrt(total), 1, min(MAX_LISTS, max(1, len(sample) // 16))))
    unit = _directions(sample)
    centroids = unit[random.choice(len(unit), lists, replace=False)]
    for _ in range(KMEANS_ROUNDS):
        near = np.argmax(unit @ centroids.T, axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, unit)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(length > 0, sums / np.where(length > 0, length, 1), centroids)
    near = np.argmax(unit @ centroids.T, axis=1)
    chosen = random.permutation(np.unique(ids, return_index=True)[1])[:TRIED_QUERIES]
    tried = sample[chosen]
    scores = tried @ sample.T
    scores[ids[chosen][:, None] == ids[None, :]] = -np.inf
    # In a sample the k best stand for more neighbours of the whole, so fewer of them are asked for.
    best = np.argsort(-scores, axis=1)[:, : max(1, min(k, len(sample) - 1))]
    order = np.argsort(-(tried @ centroids.T), axis=1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(lists)[None, :].repeat(len(tried), 0), axis=1)
    other = np.take_along_axis(scores, best, axis=1) > -np.inf
    needed = np.sort(np.take_along_axis(place, near[best], axis=1)[other])
    probes = int(needed[int(np.ceil(COVERAGE * len(needed))) - 1]) + 1 if len(needed) else lists
    return Model(rotation, centroids, sample, ids, probes)


def needed_copies(ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of all rows that can be among the k best of any query; only copies of one vector can not.

    Copies tie for every query, and the k smallest ids other than its own win. So k rows
    of an id and 2 k rows of a vector, by id, are enough: without any one id, k are left.
    """
    _, group = np.unique(rows.view(f"V{rows.itemsize * rows.shape[1]}").ravel(), return_inverse=True)
    order = np.lexsort((ids, group))
    for most, names in ((k, (group, ids)), (2 * k, (group,))):
        new = np.any([np.diff(name[order], prepend=name[order[0]] - 1) != 0 for name in names], axis=0)
        place = np.arange(len(order))
        order = order[place - np.maximum.accumulate(np.where(new, place, 0)) < most]
    return np.sort(order)


def _packs(model: Model, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of one list together: ids, originals, and rotated columns block by block."""

    def packed(ids: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
        kept = needed_copies(ids, rows, k)
        ids, rows = ids[kept], rows[kept]
        near = np.argmax(rows @ model.centroids.T, axis=1)
        order = np.argsort(near, kind="stable")
        names, starts = np.unique(near[order], return_index=True)
        parts = [order[a:b] for a, b in zip(starts, [*starts[1:], len(order)])]
        turned = (rows @ model.rotation).astype(np.float32)
        blocks = [b"".join(turned[p, c : c + COLUMNS].tobytes() for c in range(0, turned.shape[1], COLUMNS)) for p in parts]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(names.astype(np.int64)), pa.array([ids[p].tobytes() for p in parts], pa.binary()),
                pa.array([rows[p].tobytes() for p in parts], pa.binary()), pa.array(blocks, pa.binary()),
            ],
            names=["list", "ids", "rows", "blocks"],
        )

    ids, rows, held = [], [], 0
    for batch in batches:
        ids.append(batch.column(0).to_numpy())
        rows.append(matrix(batch.column(1)))
        held += batch.num_rows
        if held >= GATHERED:
            yield packed(np.concatenate(ids), np.concatenate(rows))
            ids, rows, held = [], [], 0
    if held:
        yield packed(np.concatenate(ids), np.concatenate(rows))


def survivors(blocks: list[np.ndarray], asked: np.ndarray, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (candidate, query) that no test abandoned.

    With |c|, |q| and the partial products of the first d of D rotated columns, D / d
    times the partial distance estimates the whole one; a candidate that exceeds the
    distance of the k-th best by the test's margin goes. All limits allow for the rounding
    of the 32-bit blocks, so that copies and ties stay.
    """
    dims = asked.shape[1]
    norms = sum((b.astype(np.float64) ** 2).sum(axis=1) for b in blocks)
    lengths = norms[:, None] + (asked**2).sum(axis=1)[None, :]
    limit, slack = lengths - 2 * floors[None, :], ROUNDING * lengths
    rows, columns = np.nonzero(limit >= -slack)
    limit, slack = np.maximum(limit, 0)[rows, columns], 2 * slack[rows, columns]
    partial, at = np.zeros(len(rows)), 0
    dense = True
    for block in blocks:
        width = block.shape[1]
        query = asked[:, at : at + width].astype(np.float32)
        if dense:
            dots = (block @ query.T)[rows, columns]
        else:
            dots = np.einsum("ij,ij->i", block[rows], query[columns])
        partial += (block**2).sum(axis=1)[rows] + (query**2).sum(axis=1)[columns] - 2 * dots
        at += width
        doubt = (1 + DOUBT / np.sqrt(at)) ** 2 * at / dims if at < dims else 1
        alive = partial <= limit * doubt + slack
        rows, columns, limit, partial, slack = rows[alive], columns[alive], limit[alive], partial[alive], slack[alive]
        dense = len(rows) > 0.25 * block.shape[0] * len(asked)
    return rows, columns


def _scan(tops: TopLists, model: Model, wave: tuple, row: dict) -> None:
    query_ids, queries, probed, floors = wave
    asking = np.flatnonzero(probed[:, row["list"]])
    if not len(asking):
        return
    dims = queries.shape[1]
    ids = np.frombuffer(row["ids"], np.int64)
    rows = np.frombuffer(row["rows"], np.float64).reshape(len(ids), dims)
    flat, blocks, at = np.frombuffer(row["blocks"], np.float32), [], 0
    for c in range(0, dims, COLUMNS):
        width = min(COLUMNS, dims - c)
        blocks.append(flat[at : at + len(ids) * width].reshape(len(ids), width))
        at += len(ids) * width
    for at, first in ((a, f) for a in range(0, len(ids), SCANNED) for f in range(0, len(asking), 256)):
        part = asking[first : first + 256]
        floor = np.array([max(floors[q], tops.floor(q)) for q in part])
        c, q = survivors([b[at : at + SCANNED] for b in blocks], queries[part] @ model.rotation, floor)
        c += at
        own = ids[c] == query_ids[part][q]
        c, q = c[~own], q[~own]
        cuts = range(0, len(c), PAIRS)
        scores = np.concatenate([np.zeros(0), *((rows[c[i : i + PAIRS]] * queries[part[q[i : i + PAIRS]]]).sum(axis=1) for i in cuts)])
        order = np.argsort(q, kind="stable")
        c, q, scores = c[order], q[order], scores[order]
        names, starts = np.unique(q, return_index=True)
        for name, a, b in zip(names.tolist(), starts.tolist(), [*starts[1:].tolist(), len(q)]):
            tops.add(int(part[name]), ids[c[a:b]], scores[a:b])


def _scan_all(tops: TopLists, wave: tuple, row: dict) -> None:
    """Every row of a list against every query, without floors of the sample or tests of a part."""
    query_ids, queries = wave[:2]
    ids = np.frombuffer(row["ids"], np.int64)
    rows = np.frombuffer(row["rows"], np.float64).reshape(len(ids), queries.shape[1])
    for at in range(0, len(ids), SCANNED):
        part, named = rows[at : at + SCANNED], ids[at : at + SCANNED]
        longest = np.linalg.norm(part, axis=1).max()
        for first in range(0, len(queries), 256):
            block = queries[first : first + 256]
            near = block @ part.T
            near[query_ids[first : first + 256][:, None] == named[None, :]] = -np.inf
            last = len(named) - min(tops.k, len(named))
            least = np.partition(near, last, axis=1)[:, last]
            slack = 1e-9 * longest * np.linalg.norm(block, axis=1)
            for i in range(len(block)):
                bound = max(least[i], tops.floor(first + i)) - slack[i]
                kept = np.flatnonzero((near[i] >= bound) & (near[i] > -np.inf))
                if len(kept):
                    tops.add(first + i, named[kept], (part[kept] * block[i]).sum(axis=1))


def _prepared(model: Model, ids: np.ndarray, queries: np.ndarray, k: int) -> tuple:
    """The lists each query probes, and a score its k-th best surely reaches: the k-th best of the sample's other ids."""
    order = np.argsort(-(queries @ model.centroids.T), axis=1)[:, : model.probes]
    probed = np.zeros((len(ids), len(model.centroids)), bool)
    np.put_along_axis(probed, order, True, axis=1)
    floors = np.full(len(ids), -np.inf)
    if len(model.sample) >= k:
        for first in range(0, len(ids), 256):
            scores = queries[first : first + 256] @ model.sample.T
            scores[ids[first : first + 256][:, None] == model.sample_ids[None, :]] = -np.inf
            floors[first : first + 256] = np.partition(scores, -k, axis=1)[:, -k] - 1e-9
    return ids, queries, probed, floors


def nearest(embeddings: DataFrame, chosen: Column, k: int = 20, fit_rows: int = FIT_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every chosen row among all other ids.

    The score is the inner product in doubles on the original vectors; ties go to the
    smaller vec_id. Rows without an id, vectors that are null, zero, empty, hold a null or
    a non-finite component, or have another length than most take no part. All rows of
    the query's id are its own. Repeated rows of an id are candidates each; as a query an
    id asks once. Every row is indexed, save copies that 2 k of smaller ids outdo; about ``fit_rows`` of them fit the index. Queries
    of which probed lists give fewer than k rows compare every row, without tests that
    abandon some. An empty table gives no rows.
    """
    spark = embeddings.sparkSession
    vectors = valid_vectors(embeddings, zero=False)
    total = vectors.count()
    share = min(1.0, fit_rows / max(total, 1))
    low = F.xxhash64("vec_id").bitwiseAND(F.lit((1 << 62) - 1))
    taken = vectors.filter(low < int(share * (1 << 62))).orderBy(low, "vec_id", "vec").limit(2 * fit_rows).toArrow()
    if not taken.num_rows:
        taken = vectors.orderBy("vec_id").limit(1).toArrow()
    if not taken.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    model = fit(matrix(taken.column("vec").combine_chunks()), taken.column("vec_id").to_numpy(), total, k)
    shared = spark.sparkContext.broadcast(model)
    ddl = "list long, ids binary, rows binary, blocks binary"
    index = saved(mapped(vectors, lambda batches: _packs(shared.value, k, batches), ddl), "vector-lists")
    tasks = index.rdd.getNumPartitions()
    queries = saved(query_rows(vectors, chosen), "queries")

    def wave(part: DataFrame, every_list: bool) -> DataFrame:
        table = part.toArrow()
        ids, rows = table.column("vec_id").to_numpy(), matrix(table.column("vec").combine_chunks())
        prepared = _prepared(model, ids, rows, k) if len(ids) and not every_list else (ids, rows, np.zeros((0, 0), bool), np.zeros(0))
        asked = spark.sparkContext.broadcast(prepared)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tops = TopLists(len(asked.value[0]), k)
            for batch in in_slices(batches, 1):
                if not len(asked.value[0]):
                    continue
                if every_list:
                    _scan_all(tops, asked.value, batch.to_pylist()[0])
                else:
                    _scan(tops, shared.value, asked.value, batch.to_pylist()[0])
            yield tops.batch(asked.value[0], TaskContext.get().partitionId(), pa.float64())

        lists = mapped(index, run, TOP_DDL.format(score="double"))
        return merged_lists(lists, tasks, k)

    found = searched(wave(part, False) for part in waves(queries))
    short = found.groupBy("query_id").count().filter(F.col("count") < min(k, total))
    answered = found.select("query_id").distinct()
    lacking = queries.join(short, F.col("vec_id") == F.col("query_id"), "left_semi").union(
        queries.join(answered, F.col("vec_id") == F.col("query_id"), "left_anti")
    )
    lacking = saved(lacking, "short-queries")
    if not lacking.limit(1).count():
        return found
    again = searched(wave(part, True) for part in waves(lacking))
    return found.join(lacking, F.col("query_id") == lacking["vec_id"], "left_anti").union(again)
