"""A Merkle manifest of a dataset: leaves per row, trees per source, and a proof for every leaf.

Leaves get gap-free ranks by a range sort. Runs of DIGITS levels are hashed in one task and
kept as a segment: the digest of its top node with digest-to-children records of all nodes
below it. Requests descend from the root, one segment at a time, by the digits of their ranks;
the children not taken are the proof. Requests that share the way down share the work.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import in_slices, mapped, saved, ship_package
from farelane.operators.lookups import small_side
from farelane.operators.numbering import number_rows

ARITY = 3
#: Levels of a segment, and segments that one group of a shuffle hashes.
DIGITS, SEGMENTS_PER_GROUP = 5, 16
WIDTH = ARITY**DIGITS
#: Copies of a segment that many equal subtrees share, at most: their requests spread over so many keys.
SHELVES = 64

STORE = pa.schema(
    [
        ("tree", pa.string()), ("block", pa.int64()), ("digest", pa.string()), ("shelf", pa.int64()), ("height", pa.int32()),
        ("levels", pa.int32()), ("parents", pa.list_(pa.string())), ("children", pa.list_(pa.string())),
        ("doc_ids", pa.list_(pa.int64())), ("others", pa.list_(pa.string())),
    ]
)
STORE_DDL = (
    "tree string, block long, digest string, shelf long, height int, levels int, parents array<string>, "
    "children array<string>, doc_ids array<long>, others array<string>"
)
FRONTIER = pa.schema(
    [
        ("tree", pa.string()), ("index", pa.int64()), ("digest", pa.string()), ("segments", pa.int32()), ("doc_id", pa.int64()),
        ("other", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("before", pa.list_(pa.string())), ("after", pa.list_(pa.string())),
    ]
)
FRONTIER_DDL = (
    "tree string, index long, digest string, segments int, doc_id long, other string, subroot string, root string, "
    "before array<string>, after array<string>"
)
PROVEN = pa.schema(
    [("doc_id", pa.int64()), ("source", pa.string()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_())]
)
PROVEN_DDL = "doc_id long, source string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"

HEX = 64


def digest_of(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _leaf(text: Column) -> Column:
    return F.sha2(F.concat(*(_field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")), _field(text)), 256)


def tampered_text() -> Column:
    """The text without line feeds where the checksum of the decimal doc_id is even; null ids and texts stay."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def leaves(docs: DataFrame, checked: Column | None = None) -> DataFrame:
    """tree, doc_id, digest, other: a leaf per row, and that of the text ``checked`` in its place."""
    tree = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))
    text = F.col("text")
    return docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), _leaf(text).alias("digest"), _leaf(text if checked is None else checked).alias("other"))


def _height(n: Column) -> Column:
    """Levels above n leaves, by counting powers: no rounding of logarithms."""
    powers = F.array(*(F.lit(ARITY**k).cast("long") for k in range(39)))
    return F.size(F.filter(powers, lambda p: p < n)).cast("int")


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """NODES of whole trees: ranks from 0, and the height of the tree."""
    ranked = number_rows(rows, "rank", order, ["tree"])
    heights = rows.groupBy("tree").agg(F.count("*").alias("n")).select("tree", _height(F.col("n")).alias("height"))
    return ranked.join(small_side(heights), "tree").select("tree", (F.col("rank") - 1).alias("rank"), "digest", "height", "doc_id", "other")


def _segment(key: tuple, table: pa.Table) -> pa.Table:
    """Hashes the segments of one group of nodes."""
    rows = sorted(table.to_pylist(), key=lambda r: r["rank"])
    found = []
    for block in sorted({r["rank"] // WIDTH for r in rows}):
        bottom = [r for r in rows if r["rank"] // WIDTH == block]
        levels, level, records = min(DIGITS, bottom[0]["height"]), [r["digest"] for r in bottom], {}
        for _ in range(levels):
            runs = ["".join(level[i : i + ARITY]) for i in range(0, len(level), ARITY)]
            level = [digest_of(run) for run in runs]
            records |= zip(level, runs)
        found.append(
            {
                "tree": bottom[0]["tree"], "block": block, "digest": level[0], "shelf": block % SHELVES, "height": bottom[0]["height"] - levels,
                "levels": levels, "parents": list(records), "children": list(records.values()),
                "doc_ids": [r["doc_id"] for r in bottom], "others": [r["other"] for r in bottom],
            }
        )
    return pa.Table.from_pylist(found, schema=STORE)


def build(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The stores of all rounds, lowest first, and tree, digest, segments: the root of every tree and the rounds it took."""
    ship_package(nodes.sparkSession)
    stores, roots, tallest = [], None, nodes.agg(F.max("height")).first()[0] or 0
    while not stores or tallest > 0:
        # Dealt by tree and place, so that a large tree is hashed by many tasks.
        dealt = nodes.withColumn("part", F.floor(F.col("rank") / (WIDTH * SEGMENTS_PER_GROUP)).cast("long")).repartition("tree", "part")
        store = saved(dealt.groupBy("tree", "part").applyInArrow(_segment, STORE_DDL), f"merkle-{len(stores)}")
        stores.append(store)
        done = store.filter("height <= 0").select("tree", "digest", F.lit(len(stores)).cast("int").alias("segments"))
        roots = done if roots is None else roots.unionByName(done)
        nothing = [F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("other")]
        nodes = store.filter("height > 0").select("tree", F.col("block").alias("rank"), "digest", "height", *nothing)
        tallest -= DIGITS
    return stores, roots


def _descended(row: dict) -> Iterator[tuple[int, str, list[str], list[str]]]:
    """Place, digest and path of every bottom node of a segment; paths lead upwards."""
    children = dict(zip(row["parents"], row["children"]))
    frontier = [(0, row["digest"], row["before"], row["after"])]
    for _ in range(row["levels"]):
        below = []
        for place, digest, before, after in frontier:
            run = children[digest]
            for digit, at in enumerate(range(0, len(run), HEX)):
                below.append((place * ARITY + digit, run[at : at + HEX], [run[:at], *before], [run[at + HEX :], *after]))
        frontier = below
    return iter(frontier)


def _step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches, 4):
        out = []
        for row in batch.to_pylist():
            for place, digest, before, after in _descended(row):
                out.append(
                    {
                        "tree": row["tree"], "index": row["index"] * WIDTH + place, "digest": digest, "segments": row["segments"],
                        "doc_id": row["doc_ids"][place], "other": row["others"][place], "subroot": row["subroot"], "root": row["root"], "before": before, "after": after,
                    }
                )
        yield pa.RecordBatch.from_pylist(out, schema=FRONTIER)


def _proven(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches, 4):
        out = []
        for row in batch.to_pylist():
            for place, leaf, before, after in _descended(row):
                folded = row["others"][place]
                for left, right in zip(before, after):
                    folded = digest_of(left + folded + right)
                siblings = "".join(left + right for left, right in zip(before, after))
                out.append(
                    {
                        "doc_id": row["doc_ids"][place], "source": row["tree"][1:] if row["tree"] else None, "leaf": leaf, "subroot": row["subroot"],
                        "root": row["root"], "proof_sha256": digest_of(siblings), "folded_root": folded, "verified": folded == row["root"],
                    }
                )
        yield pa.RecordBatch.from_pylist(out, schema=PROVEN)


def _descend(stores: list[DataFrame], starts: DataFrame, last, ddl: str) -> DataFrame:
    """Requests for all leaves below ``starts``, a segment at a time; trees join at the round of their top."""
    frontier = None
    for number in reversed(range(len(stores))):
        entering = starts.filter(F.col("segments") == number + 1)
        frontier = entering if frontier is None else frontier.unionByName(entering)
        records = stores[number].select("digest", "shelf", "levels", "parents", "children", "doc_ids", "others").dropDuplicates(["digest", "shelf"])
        requests = frontier.drop("doc_id", "other").withColumn("shelf", F.col("index") % SHELVES)
        joined = requests.join(records, ["digest", "shelf"])
        frontier = mapped(joined, last, ddl) if number == 0 else mapped(joined, _step, FRONTIER_DDL)
    return frontier


def prove(docs: DataFrame, checked: Column | None = None) -> DataFrame:
    """doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified of every row.

    ``checked`` gives the text whose leaf is folded up the proof (by default the row's own).
    Needs doc_id, source, lang, n_chars and text; other columns are left out. Nulls hash as
    ``-``. Rows without a source form a tree of their own, before that of the empty source.
    Within a source rows without a doc_id come first and rows of one doc_id follow in the order
    of their leaves; equal rows have equal leaves, each with a place and proof of its own. A
    tree of one leaf is that leaf. An empty table gives no row.
    """
    rows = saved(leaves(docs, checked), "merkle-leaves")
    stores, subroots = build(_ranked(rows, ["doc_id", "digest"]))
    subroots = saved(subroots, "merkle-subroots")
    named = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("other"), "digest", F.lit(None).cast("long").alias("doc_id"))
    tops, root = build(_ranked(named, ["other"]))
    none = F.array().cast("array<string>")
    start = root.select(
        "tree", F.lit(0).cast("long").alias("index"), "digest", "segments", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("other"),
        F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"), none.alias("before"), none.alias("after"),
    )
    sources = _descend(tops, start, _step, FRONTIER_DDL).drop("tree", "segments").withColumnRenamed("other", "tree")
    segments = subroots.select("tree", "segments")
    starts = saved(
        sources.join(segments, "tree").select(
            "tree", F.lit(0).cast("long").alias("index"), "digest", "segments", "doc_id", F.lit(None).cast("string").alias("other"),
            F.col("digest").alias("subroot"), "root", "before", "after",
        ),
        "merkle-starts",
    )
    return _descend(stores, starts, _proven, PROVEN_DDL)
