"""How far the sources of a language use its words differently, in exact integers.

A shard of texts is one buffer of UTF-8 bytes. Pointers to the starts of its words are sorted
by multikey quicksort, eight bytes at a time; runs of equal words then yield document frequency
and counts per source, and only these are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelane.llm.common import in_slices, mapped, saved

#: Documents of a language that must hold a word for it to count.
MIN_DOCUMENTS = 10
SCALE = 1_000_000_000
TOP_TERMS = 10
#: Bytes of text whose words are sorted together; a longer text is a shard of its own.
SHARD_BYTES = 4 << 20

#: Bytes of words are letters and all of other scripts.
IS_TERM = np.zeros(256, bool)
IS_TERM[0x41:0x5B] = IS_TERM[0x61:0x7B] = IS_TERM[0x80:] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[0x41:0x5B] += 0x20

SLICE = 8
COUNTS_DDL = "lang string, source string, term string, documents long, n long"


def _slices(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes of each word from ``depth`` on as one number, zero after its end (no word holds a zero)."""
    symbol = np.zeros(len(starts), np.uint64)
    for i in range(depth, depth + SLICE):
        byte = data[np.minimum(starts + i, len(data) - 1)].astype(np.uint64)
        symbol = symbol << np.uint64(8) | np.where(lengths > i, byte, 0)
    return symbol


def sorted_pointers(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pointers by word, ties by place, and the first of every run of equal words.

    Multikey quicksort: pointers are parted by one slice of eight bytes at a time, and only
    runs that agree so far and go on are sorted by their next slice.
    """
    order = np.arange(len(starts))
    first = np.zeros(len(starts) + 1, bool)
    first[[0, -1]] = True
    open_places, depth = np.arange(len(starts)), 0
    while len(open_places):
        mine = order[open_places]
        symbol = _slices(data, starts[mine], lengths[mine], depth)
        run = np.cumsum(first[open_places])
        moved = np.lexsort((symbol, run)) if depth else np.argsort(symbol, kind="stable")
        order[open_places] = mine[moved]
        symbol = symbol[moved]
        first[open_places[1:]] |= symbol[1:] != symbol[:-1]
        depth += SLICE
        # Runs of one pointer are settled, and so are runs whose words have all ended.
        heads = np.flatnonzero(first[open_places])
        goes_on = np.add.reduceat(lengths[order[open_places]] > depth, heads, dtype=np.int64) > 0
        sizes = np.diff(np.r_[heads, len(open_places)])
        open_places = open_places[np.repeat(goes_on & (sizes > 1), sizes)]
    return order, first[:-1]


def _counted(texts: list[bytes], groups: list[tuple[str, str]]) -> pa.RecordBatch:
    """documents and n per group and word of one shard."""
    known = {g: i for i, g in enumerate(dict.fromkeys(groups))}
    group_of = np.array([known[g] for g in groups], np.int64)
    data = LOWERED[np.frombuffer(b"\0".join([*texts, b""]), np.uint8)]
    word = np.concatenate([[False], IS_TERM[data], [False]])
    edges = np.flatnonzero(word[1:] != word[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    ends = np.cumsum([len(t) + 1 for t in texts])
    doc = np.searchsorted(ends, starts, side="right")
    order, first = sorted_pointers(data, starts, lengths)
    term = np.cumsum(first) - 1
    doc = doc[order]
    # Pointers of a word are in place order, so a document's lie side by side.
    new_doc = first | np.r_[True, doc[1:] != doc[:-1]] if len(doc) else first
    key = term * len(known) + group_of[doc]
    keys, n = np.unique(key, return_counts=True)
    documents = np.bincount(np.searchsorted(keys, key[new_doc]), minlength=len(keys))
    heads = order[first]
    raw = data.tobytes()
    words = pa.array([raw[a : a + b] for a, b in zip(starts[heads].tolist(), lengths[heads].tolist())], pa.binary()).cast(pa.string())
    names = list(known)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([g[0] for g in names], pa.string()).take(pa.array(keys % len(known))),
            pa.array([g[1] for g in names], pa.string()).take(pa.array(keys % len(known))),
            words.take(pa.array(keys // len(known))),
            pa.array(documents.astype(np.int64)),
            pa.array(n.astype(np.int64)),
        ],
        names=["lang", "source", "term", "documents", "n"],
    )


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts: list[bytes] = []
    groups: list[tuple[str, str]] = []
    held = 0
    for batch in in_slices(batches, 256):
        for lang, source, text in zip(*(batch.column(n).to_pylist() for n in ("lang", "source", "text"))):
            groups.append((lang, source))
            texts.append(text)
            held += len(text)
            if held >= SHARD_BYTES:
                yield _counted(texts, groups)
                texts, groups, held = [], [], 0
    if texts:
        yield _counted(texts, groups)


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, documents, n: rows that hold a word and its occurrences, by group.

    Shards have summed already, so the one shuffle is by word, and both the sums of a group
    and those of a language find their rows in one place.
    """
    found = mapped(_read(docs), _shards, COUNTS_DDL).repartition("lang", "term")
    return found.groupBy("lang", "source", "term").agg(F.sum("documents").alias("documents"), F.sum("n").alias("n"))


def _share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * kept)), in whole numbers of 38 digits."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (n + 2).cast("decimal(19,0)")
    below = total + 2 * kept
    return F.call_function("div", above, F.greatest(below, F.lit(1)).cast("decimal(19,0)")) + 1


def _gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def source_divergence(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank: distances between sources and their own words.

    Part ``pair`` gives for every group (lang, source) each other source of the language and
    the sum of f over all words kept; part ``term`` the ten words by which the group exceeds
    its language most. Null text, lang and source count as empty. Each row is one document, so
    repeated rows count again. Groups without words take part. Ties go to the item smaller in
    UTF-8. Other columns are left out; an empty table gives no row.

    A sum over all words needs no row for words that both sources lack or one lacks: those
    depend on a count alone and are summed by distinct count; words of both sources follow by a
    join of the kept counts, which sums before it shuffles.
    """
    counts = term_counts(docs)
    groups = _read(docs).select("lang", "source").distinct()
    word = Window.partitionBy("lang", "term")
    summed = counts.withColumns({"in_lang": F.sum("documents").over(word), "all_n": F.sum("n").over(word)})
    kept = saved(summed.filter(F.col("in_lang") >= MIN_DOCUMENTS).select("lang", "source", "term", "n", "all_n"), "kept-terms")
    langs = kept.groupBy("lang", "term").agg(F.first("all_n").alias("all_n")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("all_n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("own"))
    groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0)
    zero = _share(F.lit(0).cast("long"), F.col("total"), F.col("v"))
    groups = saved(groups.withColumn("p0", zero), "source-totals")
    shares = kept.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("v")))
    shares = saved(shares.withColumn("q", _share(F.col("all_n"), F.col("lang_total"), F.col("v"))).select("lang", "source", "term", "p", "q"), "shares")
    pairs = _pairs(shares, groups)
    terms = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _gap(F.col("p"), F.col("q")).alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    terms = terms.withColumn("rank", place).filter(F.col("rank") <= TOP_TERMS)
    pairs = pairs.withColumn("rank", place)
    return pairs.unionByName(terms)


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, part, item, value of every two sources of a language."""
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("item_p0"), F.col("own").alias("item_own"))
    both = groups.select("lang", "source", "p0", "own", "v").join(other, "lang").filter("source <> item")
    # Words of one source: as if the other lacked them all, by distinct share.
    levels = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("words"))
    alone = levels.join(other.select("lang", "item", "item_p0"), "lang").filter("source <> item")
    alone = alone.groupBy("lang", "source", "item").agg(F.sum(F.col("words") * _gap(F.col("p"), F.col("item_p0"))).alias("part_sum"))
    turned = alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "part_sum")
    # Words of both: what the two sums above said too much or too little.
    mine = shares.join(groups.select("lang", "source", "p0"), ["lang", "source"]).select("lang", "term", "source", "p", "p0")
    theirs = mine.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("item_p"), F.col("p0").alias("item_p0"))
    shared = mine.join(theirs, ["lang", "term"]).filter("source < item")
    p, q, p0, q0 = (F.col(c) for c in ("p", "item_p", "p0", "item_p0"))
    extra = _gap(p, q) - _gap(p, q0) - _gap(p0, q) + _gap(p0, q0)
    shared = shared.groupBy("lang", "source", "item").agg(F.sum(extra).alias("part_sum"))
    back = shared.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "part_sum")
    sums = alone.unionByName(turned).unionByName(shared).unionByName(back)
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("part_sum").alias("sums"))
    rest = (F.col("v") - F.col("own") - F.col("item_own")) * _gap(F.col("p0"), F.col("item_p0"))
    value = F.when(F.col("v") == 0, F.lit(0).cast("long")).otherwise(F.coalesce(F.col("sums"), F.lit(0)) + rest).cast("long")
    return both.join(sums, ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
