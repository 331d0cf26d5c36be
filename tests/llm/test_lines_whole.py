"""Line dedup with lines that share half of their hash, and with one id on a third of all rows."""

import time

import numpy as np

from farelane.llm import line_dedup
from farelane.llm.line_dedup import LineIndex


def test_lines_that_agree_in_half_of_their_hash():
    rng = np.random.default_rng(4)
    first = rng.integers(0, 1 << 63, 500).astype(np.uint64)
    second = rng.integers(0, 1 << 63, 500).astype(np.uint64)
    first[100:103] = first[7]
    first[200] = first[8]
    smallest = np.arange(500, dtype=np.int64) - 250
    index = LineIndex.from_bytes(LineIndex.build(first, second, np.full(500, 2), smallest).to_bytes())
    assert (index.owners(first, second) == smallest).all()
    unknown = index.owners(first[[7, 8, 9]], second[[8, 9, 10]])
    assert (unknown == np.iinfo(np.int64).max).all()
    alone = LineIndex.build(first[:0], second[:0], smallest[:0], smallest[:0])
    assert len(LineIndex.from_bytes(alone.to_bytes()).owners(first[:0], second[:0])) == 0


def _hot(spark, rows):
    """A third of all rows have one doc_id, each with its own text of lines that smaller ids hold."""
    lines = [f"a line that many documents hold, number {i}" for i in range(300)]
    texts = [(1 if i % 4 else 0, "\n".join(lines[i % 50 :: 2]) + f"\nown line {i} of its row") for i in range(rows)]
    texts = [(100 if i % 3 == 0 else 1000 + i if k else i, t) for i, (k, t) in enumerate(texts)]
    return texts, spark.createDataFrame(texts, "doc_id long, text string").repartition(8)


def _by_hand(texts):
    first = {}
    for doc_id, text in texts:
        for line in text.split("\n"):
            first[line] = min(doc_id, first.get(line, doc_id))
    return sorted((i, "\n".join(x for x in t.split("\n") if first[x] >= i)) for i, t in texts)


def test_a_hot_id_costs_as_much_as_its_rows(spark):
    seconds = []
    for rows in (900, 900, 3600):
        texts, docs = _hot(spark, rows)
        start = time.monotonic()
        got = sorted((r.doc_id, r.text) for r in line_dedup.drop_repeated_lines(docs).collect())
        seconds.append(time.monotonic() - start)
        assert got == _by_hand(texts)
    assert seconds[2] < 8 * seconds[1]
