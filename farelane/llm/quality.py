"""Quality classifier from weak labels.

Simple labellers vote on every document or abstain. Expectation-maximisation over the
patterns of votes estimates how accurate each labeller is and how probable a bad
document is under each pattern. Those probabilities train a linear scorer over hashed
features of a sample, which then judges every document.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import in_slices, mapped, remembered_for, saved, texts

#: Documents that vote and train the scorer, about so many, chosen by a hash of their id and text; equal rows count once.
FIT_ROWS = 16384
BITS = 12
EPOCHS, RATE, DECAY = 60, 0.5, 1e-4
EM_ROUNDS = 50
#: A document is rejected from this probability of being bad.
REJECT = 0.5

#: Facts of a word, as bits of its code.
UPPER, MARKED, BAR, PLAIN, STOP, LETTER = (1 << i for i in range(6))
PLAIN_WORD = re.compile(r"[^\W\d_]+(?:['-][^\W\d_]+)*[.,;:!?]?")
MARKS = re.compile(r"[^\w\s]{2,}$|[^\w\s.,;:!?'\"()\[\]{}<>|/@&%+=*#$-]|[#$%&*]{2,}")


def _shape(word: str) -> str:
    shape = re.sub(r"[^\W\d_]+", lambda m: "X" if m.group().isupper() and len(m.group()) > 1 else "x", word)
    return re.sub(r"(.)\1+", r"\1\1", re.sub(r"[0-9]+", "9", shape))


#: Letters of a plain word at most; longer ones are codes, run-on text or noise.
LONGEST = 40


class _Codes(dict):
    """Facts and hashed shape of each word; forgotten when there are too many, long ones at once."""

    def __missing__(self, word: str) -> int:
        if len(word) > LONGEST:
            return self._found(word)
        if len(self) > 200_000:
            self.clear()
        stem = word[:-1] if word[-1] in ".,;:!?" else word
        if stem.isalpha():
            # Plain words differ by capitals and end mark alone.
            model = ("XX" if len(stem) > 1 and stem.isupper() else "x") + word[len(stem) :]
            code = self[word] = self._code(model)
        else:
            code = self[word] = self._code(word)
        return code

    @staticmethod
    @lru_cache(maxsize=10_000)
    def _code(word: str) -> int:
        return _Codes._found(word)

    @staticmethod
    def _found(word: str) -> int:
        letters = [c for c in word if c.isalpha()]
        facts = UPPER * (len(letters) > 1 and all(c.isupper() for c in letters))
        facts |= MARKED * (MARKS.search(word) is not None) | BAR * (word == "|")
        facts |= PLAIN * (not facts & UPPER and len(word) <= LONGEST and PLAIN_WORD.fullmatch(word) is not None) | STOP * word.endswith((".", "!", "?")) | LETTER * bool(letters)
        return facts | (zlib.crc32(_shape(word).encode("utf-8", "surrogatepass")) % (1 << BITS)) << 8


_CODES = _Codes()
remembered_for((__name__,), _CODES.clear)

LABELLERS = ("prose", "capitals", "marks", "bars", "echoes", "variety", "sentences", "letters")
#: For each labeller the shares of words at which it votes bad and good, as ranges; it abstains on all others.
BAD = {
    "prose": (0, 0.8), "capitals": (0.5, 1), "marks": (0.4, 1), "bars": (0.12, 1),
    "echoes": (0.3, 1), "variety": (0.85, 1), "sentences": (0.5, 1), "letters": (0.3, 1),
}
GOOD = {"prose": (0.93, 1), "sentences": (0.03, 0.35)}
#: Labellers abstain on texts of fewer words, unless these are long.
MIN_WORDS, MIN_CHARS = 12, 400


def _repetition(ids: np.ndarray, run: int = 1000) -> float:
    """Share of words that stand earlier in the same run of words, the mean over runs."""
    parts = [ids[i : i + run] for i in range(0, len(ids), run)]
    return float(np.mean([1 - len(np.unique(part)) / len(part) for part in parts]))


def _shares(words: list[str], codes: np.ndarray) -> dict[str, float]:
    n = len(words)
    ids = np.fromiter(map(hash, words), np.int64, n)
    facts = [float(((codes & bit) > 0).mean()) for bit in (UPPER, MARKED, BAR, PLAIN, STOP, LETTER)]
    echoes = float((ids[1:] == ids[:-1]).mean()) if n > 1 else 0.0
    return {
        "prose": max(0.0, facts[3] - echoes), "capitals": facts[0], "marks": facts[1], "bars": facts[2],
        "echoes": echoes, "variety": _repetition(ids),
        "sentences": max(0.0, facts[4] - echoes), "letters": 1 - facts[5],
    }


NEVER = (2.0, 2.0)


def _within(share: float, limits: tuple[float, float]) -> bool:
    return limits[0] <= share <= limits[1]


def _described(text: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Votes as digits of base 3 (0 abstains, 1 good, 2 bad), and the features with their values."""
    words = text.split()
    codes = np.fromiter(map(_CODES.__getitem__, words), np.int64, len(words))
    if not len(words):
        return 0, np.zeros(0, np.int32), np.zeros(0, np.float32)
    shares, votes = _shares(words, codes), 0
    for name in LABELLERS:
        vote = 0
        if len(words) >= MIN_WORDS or len(text) >= MIN_CHARS:
            vote = 2 if _within(shares[name], BAD[name]) else int(_within(shares[name], GOOD.get(name, NEVER)))
        votes = votes * 3 + vote
    features, counts = np.unique(codes >> 8, return_counts=True)
    features = np.r_[features, (1 << BITS) + np.arange(len(LABELLERS))]
    values = np.r_[np.sqrt(counts / len(words)), [np.sqrt(shares[n]) for n in LABELLERS]]
    return votes, features.astype(np.int32), values.astype(np.float32)


def vote_matrix(patterns: np.ndarray) -> np.ndarray:
    """One row per pattern, one column per labeller: 0 abstains, 1 good, 2 bad."""
    return np.stack([patterns // 3 ** (len(LABELLERS) - 1 - i) % 3 for i in range(len(LABELLERS))], axis=1)


def fit_votes(patterns: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of bad for every pattern, and ``rates[truth, vote, labeller]``.

    ``rates`` says how often a labeller votes good (0) or bad (1) on good (0) and bad (1)
    documents; rates of both classes give its accuracy. To abstain says nothing. The
    start, labellers that are mostly right, keeps the meaning of "bad".
    """
    votes = vote_matrix(patterns)
    said = np.stack([votes == 1, votes == 2]).astype(float)
    rates = np.empty((2, 2, votes.shape[1]))
    rates[0], rates[1] = [[0.9], [0.03]], [[0.1], [0.3]]
    prior, weight = 0.2, counts.astype(float)
    for _ in range(EM_ROUNDS):
        log = np.einsum("vpl,tvl->tp", said, np.log(rates))
        bad = 1 / (1 + np.exp(-np.clip(log[1] - log[0] + np.log(prior / (1 - prior)), -50, 50)))
        prior = float(np.clip((bad * weight).sum() / max(weight.sum(), 1), 0.01, 0.6))
        for truth, belief in ((0, (1 - bad) * weight), (1, bad * weight)):
            rates[truth] = np.clip((np.einsum("p,vpl->vl", belief, said) + 0.1) / (belief.sum() + 1), 1e-3, 0.999)
    return bad, rates


def fit_scorer(features: list[np.ndarray], values: list[np.ndarray], target: np.ndarray) -> np.ndarray:
    """Weights of a logistic scorer, the last one constant, by gradient steps of decreasing size per weight."""
    size = (1 << BITS) + len(LABELLERS) + 1
    rows = np.repeat(np.arange(len(features)), [len(f) for f in features])
    flat = np.concatenate(features) if features else np.zeros(0, np.int32)
    value = np.concatenate(values) if values else np.zeros(0, np.float32)
    weights, seen = np.zeros(size), np.full(size, 1e-8)
    weights[-1] = -2.0
    for _ in range(EPOCHS if len(features) else 0):
        score = np.bincount(rows, value * weights[flat], len(features)) + weights[-1]
        error = 1 / (1 + np.exp(-np.clip(score, -50, 50))) - target
        step = np.bincount(flat, value * error[rows], size) / len(features) + DECAY * weights
        step[-1] = error.mean()
        seen += step**2
        weights -= RATE * step / np.sqrt(seen)
    return weights


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches):
        found = [_described(text) for text in texts(batch.column(0))]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([v for v, _, _ in found], pa.int64()),
                pa.array([f for _, f, _ in found], pa.list_(pa.int32())),
                pa.array([x for _, _, x in found], pa.list_(pa.float32())),
            ],
            names=["votes", "features", "vals"],
        )


def train(docs: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the scorer, and the labellers' rates as ``fit_votes`` estimates them.

    Both are fitted on about ``fit_rows`` documents, chosen by a hash of id and text and never
    more than twice as many; of equal rows one is taken. The driver gets their votes and features.
    """
    share = min(1.0, fit_rows / max(docs.count(), 1))
    place = F.xxhash64("doc_id", "text")
    rows = docs.select("text", place.alias("place")).filter(F.col("place").bitwiseAND(F.lit((1 << 62) - 1)) < int(share * (1 << 62)))
    rows = rows.dropDuplicates(["place"]).select("text")
    sample = saved(mapped(rows, _votes, "votes long, features array<int>, vals array<float>"), "votes").limit(2 * fit_rows).toArrow()
    votes = sample.column("votes").to_numpy()
    patterns, which, counts = np.unique(votes, return_inverse=True, return_counts=True)
    bad, rates = fit_votes(patterns, counts)
    features = [np.array(f, np.int32) for f in sample.column("features").to_pylist()]
    values = [np.array(v, np.float32) for v in sample.column("vals").to_pylist()]
    return fit_scorer(features, values, bad[which] if len(which) else np.zeros(0)), rates


def classify(docs: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """``docs`` with bad (probability of poor quality) and keep.

    A null or empty text has no votes and no features and is kept: nothing speaks
    against it. Repeated rows get equal scores, other columns pass through, columns named
    bad or keep are replaced, and an empty table stays empty.
    """
    weights = train(docs)[0] if weights is None else weights
    docs = docs.drop("bad", "keep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            bad = []
            for text in texts(batch.column("text")):
                _, features, values = _described(text)
                score = float(values @ weights[features]) + weights[-1] if len(features) else -50.0
                bad.append(float(1 / (1 + np.exp(-np.clip(score, -50, 50)))))
            columns = [*batch.columns, pa.array(bad, pa.float64()), pa.array([b < REJECT for b in bad], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "bad", "keep"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return mapped(docs, run, f"{ddl}, bad double, keep boolean")
