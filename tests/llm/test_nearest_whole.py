"""Nearest neighbours where ids follow clusters, repeat, or name copies: nothing is lost."""

import numpy as np
from pyspark.sql import functions as F

from farelane.llm import ann

K = 20


def asked(spark, ids, vectors, **how):
    rows = [(int(i), v.tolist()) for i, v in zip(ids, vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = ann.nearest(table, F.col("vec_id") % 20 == 0, K, **how).toPandas()
    return {q: part.sort_values("rank") for q, part in found.groupby("query_id")}


def recall(found, ids, vectors, first):
    hits = wanted = 0
    for query in np.unique(ids[(ids % 20 == 0) & (ids >= first)]):
        other = np.flatnonzero(ids != query)
        scores = vectors[other] @ vectors[ids == query][0]
        best = ids[other[np.lexsort((ids[other], -scores))[:K]]]
        hits += len(set(best) & set(found[query].vec_id)) if query in found else 0
        wanted += len(set(best))
    return hits / wanted


def unit(rows):
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def test_recall_where_ids_are_sorted_by_cluster(spark):
    random = np.random.default_rng(1)
    tight = unit(random.standard_normal((4, 64)))[np.arange(9600) * 4 // 9600] + 0.02 * random.standard_normal((9600, 64))
    vectors = unit(np.concatenate([tight, random.standard_normal((6400, 64))]))
    ids = np.arange(len(vectors))
    share = recall(asked(spark, ids, vectors, fit_rows=512), ids, vectors, first=9600)
    print("recall of spread vectors after clusters:", round(share, 3))
    assert share >= 0.85


def test_ids_of_many_rows_get_all_neighbours(spark):
    random = np.random.default_rng(2)
    vectors = unit(random.standard_normal((1500, 16)))
    ids = np.r_[np.repeat([0, 20, 40], [2, 30, 500]), np.arange(1000, 1968)]
    vectors[ids == 40] = unit(vectors[ids == 40][:1] + 0.05 * random.standard_normal((500, 16)))
    vectors[ids == 20] = unit(vectors[ids == 20][:1] + 0.05 * random.standard_normal((30, 16)))
    vectors[ids == 0] = vectors[ids == 0][:1]
    found = asked(spark, ids, vectors)
    print("rows of repeated ids:", {q: len(found.get(q, ())) for q in (0, 20, 40)})
    assert all(len(found.get(q, ())) == K and q not in set(found[q].vec_id) for q in np.unique(ids[ids % 20 == 0]))


def test_copies_and_ties_are_kept(spark):
    random = np.random.default_rng(3)
    groups = unit(random.standard_normal((12, 64)))
    vectors = np.concatenate([np.repeat(groups, 300, axis=0), unit(random.standard_normal((400, 64)))])
    ids = random.permutation(len(vectors))
    found = asked(spark, ids, vectors)
    of_copies = [q for q in ids[:3600] if q % 20 == 0]
    place = dict(zip(ids.tolist(), np.arange(len(ids)).tolist()))
    right = 0
    for query in of_copies:
        copies = np.sort(ids[:3600].reshape(12, 300)[place[query] // 300])
        right += found[query].vec_id.tolist() == copies[copies != query][:K].tolist() if query in found else 0
    print("queries of copies with the right rows:", right, "of", len(of_copies))
    assert right == len(of_copies)


def test_copies_left_out_are_never_among_the_best():
    random = np.random.default_rng(4)
    for _ in range(300):
        ids, rows = random.integers(0, 12, 60), random.integers(0, 2, (60, 1)).astype(float)
        kept = ann.needed_copies(ids, rows, 3)
        for query, vector in ((q, v) for q in range(12) for v in (0.0, 1.0)):
            every = np.flatnonzero((ids != query) & (rows[:, 0] == vector))
            left = kept[(ids[kept] != query) & (rows[kept, 0] == vector)]
            assert np.sort(ids[every])[:3].tolist() == np.sort(ids[left])[:3].tolist()
