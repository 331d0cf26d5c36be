"""Source divergence, repeated strings and the Merkle manifest against brute force and edge cases."""

import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelane.llm import divergence, merkle, suffix_dedup, suffix_runs
from farelane.llm.divergence import sorted_pointers

DOCS = "doc_id long, text string, lang string, source string, n_chars long, rank int, digest string, kept string, spans string, run string, term string, part string"


def docs(spark, rows):
    """Documents of (doc_id, text, lang, source) with columns whose names the operators use."""
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), 7, "d", "k", "s", "r", "t", "p") for r in rows], DOCS)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = [rng.choice(["Straße", "Ärger", "the", "THE", "Owl", "x1y", "naïve", "漢字", "abcdefghij", "abcdefgh", "abcdefghijklmnopqrstuvwxyz"]) + rng.choice(["", "", "a", "bc"]) for _ in range(60)]
    passage = " ".join(rng.choice(words) for _ in range(40))
    found = []
    for i in range(160):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(0, 60)))
        if i % 5 == 0:
            text = text[: rng.randrange(len(text) + 1)] + passage[rng.randrange(30) :] + "\n" + text
        found.append((i, text, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", "", None])))
    found += [(200, found[3][1], "en", "s1"), (3, found[3][1], "en", "s1"), (3, passage, "en", "s2"), (None, passage, "fr", "s1"), (None, None, None, None)]
    found += [(201, None, "en", "s9"), (202, "", "it", "s9"), (203, "z" * 3000, "en", "s2"), (204, "z" * 49, "en", "s2"), (205, "z" * 50, "en", "s3"), (206, "é" * 400 + "\0" * 60 + "é" * 40, "en", "s1"), (207, "\0" * 70, "en", "s1")]
    found += [(300, "only here " * 30, "xx", "single")] * 9
    return found


def test_pointers_sorted_like_words():
    rng = random.Random(1)
    words = [bytes(rng.choice(b"ab") for _ in range(rng.choice([1, 2, 7, 8, 9, 16, 17, 30]))) for _ in range(2000)] + [b"a" * 8, b"a" * 9, b"a" * 8]
    data = np.frombuffer(b" ".join(words), np.uint8)
    sizes = np.array([len(w) for w in words])
    starts = np.cumsum(sizes + 1) - sizes - 1
    order, first = sorted_pointers(data, starts, sizes)
    got = [words[i] for i in order]
    assert got == sorted(words)
    assert first.tolist() == [True] + [a != b for a, b in zip(got, got[1:])]
    assert all(order[i] < order[i + 1] for i in range(len(order) - 1) if not first[i + 1])


def divergence_by_hand(rows):
    pattern = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    count, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        group = (lang or "", source or "")
        found = [w.lower() for w in pattern.findall((text or "").encode())]
        groups.add(group)
        count[group].update(found)
        held[group[0]].update(set(found))
    out = []
    for lang, source in groups:
        kept = [w for w, n in held[lang].items() if n >= 10]
        both = 2 * len(kept)
        total = {g: sum(count[g][w] for w in kept) for g in groups if g[0] == lang}
        every = {w: sum(count[g][w] for g in total) for w in kept}
        share = {g: {w: 1 + 10**9 * (count[g][w] + 2) // (total[g] + both) for w in kept} for g in total}
        whole = {w: 1 + 10**9 * (every[w] + 2) // (sum(total.values()) + both) for w in kept}
        p = share[lang, source]
        pairs = [(g[1], sum((p[w] - q[w]) ** 2 // (p[w] + q[w]) for w in kept)) for g, q in share.items() if g[1] != source]
        terms = [(w.decode(), (p[w] - whole[w]) ** 2 // (p[w] + whole[w])) for w in kept if count[lang, source][w] and p[w] > whole[w]]
        for part, items, most in (("pair", pairs, None), ("term", terms, 10)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)]
    return sorted(out)


def test_divergence(spark, rows):
    got = divergence.source_divergence(docs(spark, rows))
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == divergence_by_hand(rows)


def test_divergence_in_small_shards(spark, rows, monkeypatch):
    """Shards of one text count as one large shard does."""
    whole = divergence._counted([r[1].encode() for r in rows if r[1]], [("en", r[3] or "") for r in rows if r[1]]).to_pylist()
    parts = Counter()
    for r in rows:
        if r[1]:
            for c in divergence._counted([r[1].encode()], [("en", r[3] or "")]).to_pylist():
                parts[c["source"], c["term"], "documents"] += c["documents"]
                parts[c["source"], c["term"], "n"] += c["n"]
    assert {(c["source"], c["term"], k): c[k] for c in whole for k in ("documents", "n")} == dict(parts)


def removed_by_hand(rows):
    first: dict[bytes, int] = {}
    for doc_id, text, *_ in rows:
        raw = (text or "").encode()
        if doc_id is not None:
            for i in range(len(raw) - 49):
                first[raw[i : i + 50]] = min(doc_id, first.get(raw[i : i + 50], doc_id))
    out = []
    for doc_id, text, *_ in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        if doc_id is not None:
            for i in range(len(raw) - 49):
                if first[raw[i : i + 50]] < doc_id:
                    gone[i : i + 50] = b"\1" * 50
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc_id, len(raw), sum(gone), len(spans), [x for s in spans for x in s], kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize("run_bytes", [suffix_dedup.RUN_BYTES, 2000, 1])
def test_repeated_strings(spark, rows, run_bytes):
    if run_bytes == 1:
        rows = rows[::4]
    got = suffix_dedup.drop_repeated_strings(docs(spark, rows), run_bytes)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, list(r.spans), bytes(r.kept)) for r in got.collect()]
    assert sorted(got, key=repr) == removed_by_hand(rows)


def test_hot_copies_and_clean_documents(spark):
    rng = random.Random(9)
    fresh = lambda: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(20))
    copy = fresh()
    many = [(i, copy if i % 3 == 0 else fresh(), "en", "s") for i in range(600)]
    got = {r.doc_id: r for r in suffix_dedup.drop_repeated_strings(docs(spark, many), 4000).collect()}
    assert all(got[i].n_removed == (len(copy) if i % 3 == 0 and i else 0) for i in range(600))


def test_merge_gives_sorted_order():
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"ab") for _ in range(300)) for _ in range(13)]
    runs = []
    for n, part in enumerate((texts[:1], texts[1:5], texts[5:12], texts[12:])):
        laid = suffix_runs.AnchoredTexts(part, np.ones(len(part), bool))
        entries, _ = suffix_runs.Entries.of(laid, np.arange(len(laid.begin)), np.arange(len(part)) + 10 * n)
        runs.append(suffix_runs.Entries.from_bytes(entries.to_bytes()))
        for name in ("right", "right_size", "left", "left_size", "common", "smallest"):
            assert (getattr(runs[-1], name) == getattr(entries, name)).all(), name
    order, shared = suffix_runs.merge_runs(runs)
    words = [bytes(w) for r in runs for w in r.right]
    merged = [words[i] for i in order]
    assert merged == sorted(words) and sorted(order) == list(range(len(words)))
    for one, other, n in zip(merged, merged[1:], shared[1:]):
        common = next((i for i in range(suffix_runs.SPAN) if one[i] != other[i]), suffix_runs.SPAN)
        assert n == common


def copied_runs(text, copies):
    laid = suffix_runs.AnchoredTexts([text], np.ones(1, bool))
    every = np.arange(len(laid.begin))
    return [suffix_runs.Entries.of(laid, every, np.array([n]))[0] for n in range(copies)]


def test_blocks_of_a_merge_give_the_same_documents():
    rng = random.Random(3)
    runs = copied_runs(bytes(rng.choice(b"ab") for _ in range(2000)), 2) + copied_runs(bytes(rng.choice(b"a ") for _ in range(2000)), 3)
    places = lambda block: sorted((int(e), p, int(d)) for es in suffix_runs.smallest_by_place(runs, block) for e, a, n, d in zip(*es) for p in range(a, a + n + 1))
    assert places(1) == places(50) == places(10**9) != []
    assert len(list(suffix_runs.merged_blocks(runs, 50))) > 5


def test_a_slice_of_repeated_suffixes_is_merged_in_little_memory():
    rng = random.Random(1)
    words = [bytes(rng.choices(b"abcdefghijklmnop", k=6)) for _ in range(3000)]
    runs = copied_runs(b" ".join(rng.choices(words, k=40000)), 6)
    entries = suffix_dedup._rows([(n, suffix_dedup.ENTRIES, 0, e.to_bytes()) for n, e in enumerate(runs)])
    tracemalloc.start()
    rows = sum(batch.num_rows for batch in suffix_dedup._merged(iter([entries])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 5 and peak < 400 * sum(len(e.right) for e in runs)


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def manifest_by_hand(rows):
    def leaf(doc_id, text, lang, source, n):
        values = [None if v is None else str(v) for v in (doc_id, source, lang, n, text)]
        return digest(*("-" if v is None else f"{len(v.encode())}:{v}" for v in values))

    def tree(nodes):
        """Root, and (before, after) pairs up the way of each node."""
        ways, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for way, place in zip(ways, at):
                run = place // 3 * 3
                way.append(("".join(nodes[run:place]), "".join(nodes[place + 1 : run + 3])))
            nodes = [digest(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
            at = [place // 3 for place in at]
        return nodes[0], ways

    groups = defaultdict(list)
    for doc_id, text, lang, source in rows:
        n = None if text is None else len(text)
        even = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
        other = text.replace("\n", "") if even and text is not None else text
        groups[source].append((doc_id, leaf(doc_id, text, lang, source, n), leaf(doc_id, other, lang, source, n)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[name] = tree([r[1] for r in groups[name]])
    root, tops = tree([trees[name][0] for name in names])
    out = []
    for name, top in zip(names, tops):
        for (doc_id, own, other), way in zip(groups[name], trees[name][1]):
            folded = other
            for before, after in way + top:
                folded = digest(before, folded, after)
            siblings = "".join(b + a for b, a in way + top)
            out.append((doc_id, name, own, trees[name][0], root, digest(siblings), folded, folded == root))
    return sorted(out, key=repr)


def test_manifest(spark, rows):
    got = merkle.prove(docs(spark, rows), merkle.tampered_text())
    assert sorted(map(tuple, got.collect()), key=repr) == manifest_by_hand(rows)


def test_manifest_of_many_rounds(spark):
    """A source of several segments, one leaf alone, more sources than a segment holds, and equal rows."""
    many = [(i // 2, "a\nb" if i % 3 else None, "en", "big") for i in range(1300)] + [(i, "x\n", "en", f"s{i}") for i in range(260)]
    many += [(5000, "same", "en", "hot")] * 800
    got = merkle.prove(docs(spark, many), merkle.tampered_text())
    assert sorted(map(tuple, got.collect()), key=repr) == manifest_by_hand(many)


def test_untouched_texts_verify(spark, rows):
    assert merkle.prove(docs(spark, rows)).filter("not verified").count() == 0


@pytest.mark.parametrize("operator", [divergence.source_divergence, suffix_dedup.drop_repeated_strings, merkle.prove])
def test_empty_table(spark, operator):
    assert operator(docs(spark, [])).count() == 0


def test_one_long_text(spark):
    rows = [(1, "word " * 40_000, "en", "s"), (2, "word " * 40_000, "en", "s"), (3, "clean", "en", "s")]
    got = {r.doc_id: r.n_removed for r in suffix_dedup.drop_repeated_strings(docs(spark, rows)).collect()}
    assert got == {1: 0, 2: 200_000, 3: 0}
    counted = divergence.term_counts(docs(spark, rows)).filter(F.col("term") == "word").collect()
    assert [(r.documents, r.n) for r in counted] == [(2, 80_000)]
