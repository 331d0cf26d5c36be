"""Document operators against the library, brute force and hand-made edge cases."""

import random
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from farelane.llm import bpe, jaccard_join, line_dedup, packing, pii, quality, token_files
from farelane.llm.chunk_encoder import SPACED, WORDS, ChunkEncoder
from farelane.llm.common import tokenizer_file
from farelane.llm.components import components
from farelane.llm.mph import MinimalPerfectHash
from farelane.scratch import scratch_folder

SF = "/root/testdata/sf0.001"
WORD, BYTE = tokenizer_file("word_bpe_49k.json"), tokenizer_file("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, bad string, keep string, lost string, n_lines string, shard string, group string"
ODD = [
    "", " ", "a<|endoftext|>b <|startoftext|>", "I'm it's WE'LL 'S", "x" * 5000, "  two  spaces\n\n\nlines \t tab\x1cfs\x85nel",
    "Σίσυφος ΣΑΣ İstanbul", "é ́x ﬁ ½ ２３ 漢字 👍🏽", "ends ", "<|ENDOFTEXT|> it's, don't! no...", " \n x",
]


def docs(spark, rows):
    return spark.createDataFrame([(*row, "en", "b", "k", "l", "n", "s", "g") for row in rows], DOCS)


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(50, None), (None, None), (None, "no id at all"), (3, ODD[3]), (3, "other text")]
    return docs(spark, rows + [(60, "word " * 60_000), (61, "z" * 300_000)])


OPERATORS = {
    "bpe": lambda d: bpe.encode_documents(d, WORD),
    "pack": lambda d: packing.pack_documents(d, WORD, 2),
    "lines": line_dedup.drop_repeated_lines,
    "jaccard": jaccard_join.jaccard_components,
    "pii": pii.find_personal_data,
    "mask": pii.mask_personal_data,
    "quality": quality.classify,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](docs(spark, [])).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_survive(odd, name):
    found = OPERATORS[name](odd)
    assert found.count() >= odd.count()
    assert {r[0] for r in found.select("doc_id").distinct().collect()} == {r[0] for r in odd.select("doc_id").distinct().collect()}


def test_bpe_equals_library(corpus, odd):
    library = Tokenizer.from_file(WORD)
    for table in (corpus, odd):
        want = defaultdict(list)
        for row in table.collect():
            ids = library.encode(row.text or "", add_special_tokens=False).ids
            want[row.doc_id].append((len(ids), ids, library.decode(ids, skip_special_tokens=False)))
        for row in bpe.encode_documents(table, WORD).collect():
            assert (row.n_tokens, row.ids, row.decoded) in want[row.doc_id]
            assert bpe.decode(WORD, row.ids) == row.decoded


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab 'sZ\n\t é́ΣİǅªⅧ漢1½!.<|>,_\x1c​", max_size=60))
def test_encoders_equal_library_on_any_text(text):
    for encoder in ENCODERS:
        assert encoder.encode([text])[0].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    library = ENCODERS[0].tokenizer
    ids = library.encode(text, add_special_tokens=False).ids
    assert bpe.bpe_model(WORD).encode(text)[1] == " ".join(map(str, ids))


ENCODERS = [ChunkEncoder(WORD, WORDS), ChunkEncoder(BYTE, SPACED)]


def test_forced_cuts_hold_no_token():
    model = bpe.bpe_model(WORD)
    parts = model.fragments("abczqx!!qz")
    assert "".join(parts) == "abczqx!!qz" and len(parts) > 1
    assert all(a[-1] + b[0] not in model.joined for a, b in zip(parts, parts[1:]))


def test_minimal_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 20_000).astype(np.uint64))
    table = MinimalPerfectHash.from_bytes(MinimalPerfectHash.build(keys).to_bytes())
    assert sorted(table.slots(keys).tolist()) == list(range(len(keys)))
    assert len(MinimalPerfectHash.build(keys[:0]).slots(keys[:3])) == 3
    with pytest.raises(ValueError):
        MinimalPerfectHash.build(np.array([1, 1], np.uint64))


def test_token_files(spark, corpus, odd):
    library = Tokenizer.from_file(BYTE)
    for table in (corpus, odd):
        folder = scratch_folder(spark, "files")
        token_files.write_token_files(table, folder, BYTE, 0, shard_ids=4000)
        found = token_files.read_documents(spark, folder).orderBy("start").collect()
        want = defaultdict(list)
        for row in table.collect():
            ids = np.array(library.encode(row.text or "", add_special_tokens=False).ids + [0], "<u4")
            want[row.doc_id].append((len(ids), zlib.crc32(ids.tobytes())))
        start = 0
        for row in found:
            assert row.start == start and (row.n_tokens, row.ids_crc32) in want[row.doc_id]
            start += row.n_tokens
        ids = [r.doc_id for r in found]
        assert ids == sorted(ids, key=lambda i: (i is not None, i)) and len(found) == table.count()
    some = token_files.read_keys(spark, folder, [3, 50, 999]).collect()
    assert sorted(r.doc_id for r in some) == [3, 3, 3, 50]
    assert [r.ids for r in some if r.doc_id == 50] == [[0]]
    assert token_files.read_keys(spark, folder, []).count() == 0
    with pytest.raises(ValueError):
        token_files.read_keys(spark, folder, list(range(token_files.MAX_KEYS + 1)))


def test_packing_is_whole_and_tight(corpus):
    library = Tokenizer.from_file(WORD)
    pieces = packing.pack_documents(corpus, WORD, 2).toPandas()
    ids = {r.doc_id: library.encode(r.text, add_special_tokens=False).ids + [2] for r in corpus.collect()}
    for doc, part in pieces.sort_values("start").groupby("doc_id"):
        at = 0
        for row in part.itertuples():
            cut = np.array(ids[doc][at : at + row.length], "<u4")
            assert (row.start, row.doc_tokens, row.ids_crc32) == (at, len(ids[doc]), zlib.crc32(cut.tobytes()))
            at += row.length
        assert at == len(ids[doc])
    for _, part in pieces.sort_values("offset").groupby("sequence_id"):
        assert part.offset.tolist() == [0, *part.length.cumsum().tolist()[:-1]]
        assert part.length.sum() <= packing.WINDOW and (part.padded == packing.padded_length(int(part.length.sum()))).all()
    stored = pieces.groupby("sequence_id").padded.first().sum()
    assert 1 - pieces.length.sum() / stored < 0.01


def test_best_cuts_equal_plain_dynamic_programming():
    random.seed(2)
    for _ in range(60):
        places = sorted(random.sample(range(1, 60), random.randint(3, 25)))
        places = np.array(sorted({*places, *range(10, 61, 10)}))
        fine = np.array([random.choice([0, 6, 48]) for _ in places])
        window, at = 16, [0, *places.tolist()]
        best = [0] + [10**9] * len(places)

        def price(a, b):
            return (packing.padded_length(b - a, window) - (b - a)) + packing.SEQUENCE

        for j in range(1, len(at)):
            best[j] = min(best[i] + price(at[i], at[j]) for i in range(j) if at[j] - at[i] <= window) + int(fine[j - 1])
        cuts = [0, *packing.best_cuts(places, fine, window)]
        cost = sum(price(a, b) for a, b in zip(cuts, cuts[1:])) + sum(int(fine[places.tolist().index(c)]) for c in cuts[1:])
        assert cost == best[-1]


def test_lines_by_brute_force(spark):
    rows = [
        (5, "  Shared line here \nown line of five\nshort"), (2, "SHARED LINE HERE\nshort\n\n"), (9, "shared line here\nshared line here"),
        (2, "shared line here"), (7, None), (None, "shared line here"), (8, "Ünïcode\nÜnïcode öä"), (10, "Ünïcode öä"), (11, "ä" * 9), (12, "ä" * 9),
    ]
    found = {(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in line_dedup.drop_repeated_lines(docs(spark, rows)).collect()}
    assert found == {
        (5, "own line of five\nshort", 3, 1), (2, "SHARED LINE HERE\nshort\n\n", 4, 0), (9, "", 2, 2), (2, "shared line here", 1, 0),
        (7, "", 1, 0), (None, "shared line here", 1, 0), (8, "Ünïcode\nÜnïcode öä", 2, 0), (10, "", 1, 1), (11, "ä" * 9, 1, 0), (12, "ä" * 9, 1, 0),
    }


def _components(sets):
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def _words(text):
    words = (text or "").encode().lower().split()
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_jaccard_by_brute_force(spark, corpus):
    random.seed(4)
    base = [f"w{i}" for i in range(60)]
    rows = [(1000 + i, " ".join(w if random.random() > 0.004 * (i % 30) else f"x{i}" for w in base)) for i in range(120)]
    rows += [(i, r) for i, r in enumerate(["one two", "One  TWO", "one", "", None, " \n"])]
    rows += [(r.doc_id + 5000, r.text) for r in corpus.collect()]
    want = _components({i: _words(t) for i, t in rows})
    found = jaccard_join.jaccard_components(docs(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in found} == want
    assert {r.doc_id: r.n_shingles for r in found} == {i: len(_words(t)) for i, t in rows}


def test_jaccard_without_ids(spark):
    found = jaccard_join.jaccard_components(docs(spark, [(None, "a b c"), (4, "A b C"), (None, "d"), (4, "e f")])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in found) == [(-1, -1), (-1, 4), (4, 4), (4, 4)]


def test_components_of_a_long_chain(spark):
    pairs = [(i + 1, i) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    found = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_quality_on_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = quality.classify(spark.read.parquet(f"{sf}/documents.parquet")).join(labels, "doc_id").toPandas()
    assert (judged.keep == (judged.quality == 1)).mean() > 0.97
    assert judged[judged.quality == 1].keep.mean() > 0.99


def test_votes_find_the_bad_labeller():
    random.seed(3)
    counts = defaultdict(int)
    for _ in range(4000):
        bad = random.random() < 0.2
        votes = 0
        for i in range(len(quality.LABELLERS)):
            right = random.random() < (0.55 if i == 3 else 0.9)
            votes = votes * 3 + (2 if bad == right else 1)
        counts[votes] += 1
    patterns = np.array(sorted(counts))
    _, rates = quality.fit_votes(patterns, np.array([counts[p] for p in patterns.tolist()]))
    hits = rates[1, 1]
    assert hits[3] < 0.7 and all(h > 0.8 for i, h in enumerate(hits) if i != 3)


PERSONAL = "Mail a.b@c.example.org, +1 (743) 555-3824; 10.0.0.255 and 999.1.1.1, card 4111 1111 1111 1111 x@y a@b.c.@d.e"


def test_base_spans():
    found = [(k, PERSONAL[a:b]) for a, b, k in pii.base_spans(PERSONAL)]
    assert found == [
        ("email", "a.b@c.example.org"), ("phone", "+1 (743) 555-3824"), ("ip", "10.0.0.255"),
        ("card", "4111 1111 1111 1111"), ("email", "a@b.c"), ("email", ".@d.e"),
    ]


#: The patterns as they are given.
PLAIN_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
PLAIN_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="a.@-+% 1_\n", max_size=40))
def test_emails_equal_plain_matching(text):
    assert [(a, b) for a, b, _ in pii._emails(text)] == [m.span() for m in PLAIN_EMAIL.finditer(text)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="0125.a", max_size=40))
def test_addresses_equal_plain_matching(text):
    assert [m.span() for m in pii.IP.finditer(text)] == [m.span() for m in PLAIN_IP.finditer(text)]


@pytest.mark.parametrize("text", ["9" * 300_000, "a@" + "a" * 300_000, "1.2.3.4 743-555-2222 " * 15_000])
def test_long_runs_take_linear_time(text):
    began = time.process_time()
    pii.all_spans(text, {"call me:": "phone"})
    assert time.process_time() - began < 20


def test_contexts_find_unseen_identifiers(spark):
    rows = [(i, f"text {'abc'[i % 3]} then call me: +1 (743) 555-{1000 + i} bye") for i in range(40)]
    rows += [(100, "please call me: 743-555-2222 now"), (101, "invoice 743-555-2222 paid"), (102, "Σ call me: 743-555-3333")]
    table = docs(spark, rows)
    patterns = pii.reliable_patterns(table)
    assert patterns == {"call me:": "phone"}
    found = {r.doc_id: r for r in pii.find_personal_data(table, patterns).collect()}
    assert found[100].spans == "phone:16:28" and found[100].n_phone == 0 and found[100].base_spans == ""
    assert found[101].spans == "" and found[102].spans == "phone:11:23"
    masked = {r.doc_id: r.text for r in pii.mask_personal_data(table, patterns).collect()}
    assert masked[100] == "please call me: [PHONE] now" and masked[101] == rows[41][1]
