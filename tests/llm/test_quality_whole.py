"""The vote model against a plain loop, long words, and a repeated row that holds a third of all rows."""

import math
import random

import numpy as np

from farelane.llm import quality


def plain_em(rows):
    """Expectation-maximisation as written in books, document by document."""
    n = len(rows[0])
    rates = [[[0.9] * n, [0.03] * n], [[0.1] * n, [0.3] * n]]
    prior = 0.2
    for _ in range(quality.EM_ROUNDS):
        bad = []
        for row in rows:
            log = [0.0, 0.0]
            for truth in (0, 1):
                for i, vote in enumerate(row):
                    if vote:
                        log[truth] += math.log(rates[truth][vote - 1][i])
            score = log[1] - log[0] + math.log(prior / (1 - prior))
            bad.append(1 / (1 + math.exp(-min(max(score, -50), 50))))
        prior = min(max(sum(bad) / len(rows), 0.01), 0.6)
        for truth in (0, 1):
            belief = [b if truth else 1 - b for b in bad]
            for i in range(n):
                for vote in (1, 2):
                    said = sum(w for w, row in zip(belief, rows) if row[i] == vote)
                    rates[truth][vote - 1][i] = min(max((said + 0.1) / (sum(belief) + 1), 1e-3), 0.999)
    return bad, rates


def test_votes_are_fitted_as_by_a_plain_loop():
    rng = random.Random(6)
    rows = []
    for _ in range(300):
        truth = rng.random() < 0.3
        rows.append([0 if rng.random() < 0.4 else 1 + (truth if rng.random() < 0.8 else 1 - truth) for _ in quality.LABELLERS])
    codes = [sum(int(v) * 3 ** (len(row) - 1 - i) for i, v in enumerate(row)) for row in rows]
    patterns, which, counts = np.unique(codes, return_inverse=True, return_counts=True)
    bad, rates = quality.fit_votes(patterns, counts)
    expected, expected_rates = plain_em(rows)
    assert np.allclose(bad[which], expected, atol=1e-6)
    assert np.allclose(rates, np.array(expected_rates), atol=1e-6)


def test_long_words_count_as_a_whole():
    tail = "x" * 60 + "#1#" * 5
    assert quality._shape("x" * 50 + "1") != quality._shape("x" * 50)
    assert quality._CODES["y" * 60] != quality._CODES[tail] and "y" * 60 not in quality._CODES
    votes, features, _ = quality._described("z" * 5000)
    assert votes and len(features) > len(quality.LABELLERS)
    assert quality._described("z")[0] == 0


def test_a_repeated_row_does_not_fill_the_sample(spark):
    rng = random.Random(8)
    prose = ["the", "river", "runs", "under", "a", "bridge", "and", "people", "walk", "there", "slowly", "home"]
    rows = [(5, "$$$ ### BUY NOW " * 20)] * 400
    for i in range(400):
        rows.append((100 + i, ". ".join(" ".join(rng.choice(prose) for _ in range(9)) for _ in range(6)) + "."))
        rows.append((1000 + i, " | ".join(rng.choice(["BUY", "NOW", "$$$", "###"]) for _ in range(40))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for fit_rows in (16384, 60):
        weights, _ = quality.train(docs, fit_rows)
        judged = {r.doc_id: r.keep for r in quality.classify(docs, weights).collect()}
        kept = [judged[100 + i] for i in range(400)]
        assert sum(kept) == 400 and not any(judged[1000 + i] for i in range(400))
