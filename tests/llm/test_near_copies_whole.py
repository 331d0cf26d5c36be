"""Near copies among repeated and missing ids: one row of each group stays, and all other texts."""

import random
from collections import Counter

import corpus_pipeline
from farelane.llm import jaccard_join

COPIED = " ".join(f"word{i}" for i in range(60))
NEAR = COPIED + " more"
LONE, OTHER, UNNAMED = (" ".join(f"{name}{i}" for i in range(30)) for name in ("lone", "other", "unnamed"))
ROWS = [
    (1, COPIED), (5, NEAR), (5, LONE), (5, LONE), (7, OTHER), (7, OTHER + " end"), (None, COPIED), (None, UNNAMED),
    (None, UNNAMED), (None, UNNAMED + " end"), (8, ""), (8, ""), (9, None), (5, OTHER),
]


def test_repeated_and_missing_ids(spark):
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in ROWS]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = corpus_pipeline.near_copies(spark, docs, "")
    assert found.dtypes == docs.dtypes
    kept = [(r.doc_id, r.text) for r in found.collect()]
    assert sorted(kept, key=repr) == sorted([(1, COPIED), (5, LONE), (5, OTHER), (None, UNNAMED), (8, ""), (8, ""), (9, None)], key=repr)


def _pairs_by_brute_force(rows):
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    least = {i: i for i in sets}

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    for a, x in sets.items():
        for b, y in sets.items():
            if a < b and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((find(a), find(b)))
                least[high] = low
    return {i: find(i) for i in sets}


def _found(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect()}


def test_groups_of_one_prefix_are_expanded(spark):
    """Many different sets share prefix and size: all are compared, within the group and across groups."""
    random.seed(6)
    base = [f"base{i}" for i in range(90)]
    rows = []
    for i in range(400):
        words = list(base)
        for k in random.sample(range(90), random.choice([1, 1, 2, 3])):
            words[k] = f"new{i}x{k}"
        rows.append((i, " ".join(words)))
    prefixes = []
    for _, text in rows:
        found = jaccard_join.shingles(text.encode())
        prefixes.append((found[: jaccard_join.prefix_length(len(found))].tobytes(), len(found)))
    assert max(Counter(prefixes).values()) > 5
    assert _found(spark, rows) == _pairs_by_brute_force(rows)


def test_texts_of_shared_blocks(spark):
    """Texts made from few blocks meet in many shingles; few link."""
    random.seed(7)
    blocks = [" ".join(f"block{b}word{i}" for i in range(25)) for b in range(12)]
    rows = [(i, " ".join(random.sample(blocks, 5))) for i in range(300)]
    rows += [(1000 + i, rows[i][1] + f" tail{i}") for i in range(0, 300, 7)]
    assert _found(spark, rows) == _pairs_by_brute_force(rows)


def test_members_of_one_group_that_do_not_link(spark, monkeypatch):
    """All sets of one size are made one group: its members in different components are compared, each pair once."""
    random.seed(8)
    monkeypatch.setattr(jaccard_join, "group_of", lambda prefix, size: size)
    rows = [(i, " ".join(f"t{i % 9}w{k}" if k != i else f"own{i}" for k in range(60))) for i in range(54)]
    assert _found(spark, rows) == _pairs_by_brute_force(rows)
