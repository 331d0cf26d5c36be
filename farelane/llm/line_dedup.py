"""Removal of lines that other documents hold too, by a sharded minimal perfect hash.

The hashes of repeated lines are dealt to shards. Each shard's index is a minimal
perfect hash that leads to compact arrays of fingerprints, counts and first documents.
Documents send the hashes of their lines to the shards, whose arrays they probe; no
text and no line is joined.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import in_slices, mapped, row_key, saved, shuffle_tasks, utf8
from farelane.llm.mph import MinimalPerfectHash

#: What is stripped from both ends of a line.
BLANK = b" \t\n\x0b\x0c\r"
MIN_CHARS = 10
#: Distinct repeated lines per shard, and shards at most; beyond, shards grow.
SHARD_LINES = 8192
MAX_SHARDS = 16384
#: Probing groups per shuffle task; a shard with many probes gets several of them.
GROUPS_PER_TASK = 4

ANY = np.uint64(0x7FFFFFFFFFFFFFFF)


def line_key(line: bytes) -> bytes | None:
    """A line's key, or None if it has fewer than MIN_CHARS code points."""
    key = line.strip(BLANK).lower()
    if len(key) < MIN_CHARS or (len(key) < 4 * MIN_CHARS and not key.isascii() and len(key.decode()) < MIN_CHARS):
        return None
    return key


def line_hashes(text: bytes) -> list[bytes | None]:
    """A 128-bit hash of every line's key, None for lines that always stay."""
    return [
        None if (key := line_key(line)) is None else xxhash.xxh3_128_digest(key) for line in text.split(b"\n")
    ]


def _halves(hashes: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(hashes, "<u8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _distinct(text: bytes) -> bytes:
    return b"".join({h for h in line_hashes(text) if h is not None})


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches):
        hashes = [_distinct(text) for text in utf8(batch.column(1))]
        first, second = _halves(b"".join(hashes))
        lines = np.array([len(h) // 16 for h in hashes], np.int64)
        ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), lines)
        yield pa.RecordBatch.from_arrays(
            [pa.array(first.view(np.int64)), pa.array(second.view(np.int64)), pa.array(ids, pa.int64())],
            names=["first", "second", "doc_id"],
        )


def repeated_lines(docs: DataFrame) -> DataFrame:
    """first, second (halves of the hash), documents, smallest: lines found under two or more doc_ids."""
    lines = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", "text")
    return (
        mapped(lines, _occurrences, "first long, second long, doc_id long")
        .groupBy("first", "second")
        .agg(F.count("*").alias("documents"), F.min("doc_id").alias("smallest"), F.max("doc_id").alias("largest"))
        .filter("smallest < largest")
        .drop("largest")
    )


class LineIndex:
    """One shard: slots of a minimal perfect hash over fingerprints, counts and first documents.

    The hash is built on the first half of the lines' hashes. Of lines that agree there all but
    one go to a short list at the end, which is searched for lines that their slot denies.
    """

    def __init__(self, table: MinimalPerfectHash, prints: np.ndarray, counts: np.ndarray, smallest: np.ndarray, more: np.ndarray):
        self.table, self.prints, self.counts, self.smallest, self.more = table, prints, counts, smallest, more
        self.others = {(a, b): owner for a, b, owner in zip(more[0].tolist(), more[1].tolist(), more[2].view(np.int64).tolist())}

    @classmethod
    def build(cls, first, second, counts, smallest) -> LineIndex:
        _, one = np.unique(first, return_index=True)
        rest = np.setdiff1d(np.arange(len(first)), one)
        more = np.stack([first[rest], second[rest], smallest[rest].astype(np.int64).view(np.uint64)])
        table = MinimalPerfectHash.build(first[one])
        order = one[np.argsort(table.slots(first[one]))]
        return cls(table, second[order], counts[order], smallest[order], more)

    def to_bytes(self) -> bytes:
        table = self.table.to_bytes()
        return b"".join(
            [struct.pack("<Q", len(table)), table, self.prints.tobytes(), self.counts.tobytes(), self.smallest.tobytes(), self.more.tobytes()]
        )

    @classmethod
    def from_bytes(cls, data: bytes) -> LineIndex:
        (length,) = struct.unpack_from("<Q", data)
        table = MinimalPerfectHash.from_bytes(data[8 : 8 + length])
        at, n = 8 + length, table.size
        return cls(
            table,
            np.frombuffer(data, "<u8", n, at),
            np.frombuffer(data, "<i8", n, at + 8 * n),
            np.frombuffer(data, "<i8", n, at + 16 * n),
            np.frombuffer(data, "<u8", -1, at + 24 * n).reshape(3, -1) if len(data) > at + 24 * n else np.zeros((3, 0), np.uint64),
        )

    def owners(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The smallest document of each line, or its largest possible value where the index lacks the line."""
        slots = self.table.slots(first)
        known = slots >= 0
        known[known] = self.prints[slots[known]] == second[known]
        found = np.full(len(first), np.iinfo(np.int64).max)
        found[known] = self.smallest[slots[known]]
        if self.others:
            for i in np.flatnonzero(~known):
                found[i] = self.others.get((int(first[i]), int(second[i])), found[i])
        return found


def _shards_of(first: np.ndarray, shards: int) -> np.ndarray:
    return ((first & ANY) % np.uint64(shards)).astype(np.int64)


def _index_rows(repeated: DataFrame, shards: int, salts: dict[int, int]) -> DataFrame:
    """One row per shard and salt with the shard's arrays."""

    def build(key: tuple, table: pa.Table) -> pa.Table:
        first, second, counts, smallest = (table.column(n).to_numpy() for n in ("first", "second", "documents", "smallest"))
        index = LineIndex.build(first.view(np.uint64), second.view(np.uint64), counts, smallest)
        shard = key[0].as_py()
        return pa.table({"shard": [shard], "salts": pa.array([salts[shard]], pa.int64()), "data": [index.to_bytes()]})

    indexes = repeated.withColumn("shard", _shard_column(shards)).groupBy("shard").applyInArrow(
        build, "shard long, salts long, data binary"
    )
    return indexes.select(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"),
        F.lit(0).alias("kind"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("tie"), "data",
    )


def _shard_column(shards: int):
    return F.col("first").bitwiseAND(F.lit(int(ANY))) % F.lit(shards)


def _probe_rows(docs: DataFrame, shards: int, salts: dict[int, int]) -> DataFrame:
    """The hashes of a document's lines, packed by shard."""
    spread = np.array([salts.get(s, 0) for s in range(shards)], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            hashes = [_distinct(text) for text in utf8(batch.column(1))]
            both = np.frombuffer(b"".join(hashes), "<u8").reshape(-1, 2)
            rows = np.repeat(np.arange(len(hashes)), [len(h) // 16 for h in hashes])
            shard = _shards_of(both[:, 0], shards)
            order = np.lexsort((shard, rows))
            both, rows, shard = both[order], rows[order], shard[order]
            starts = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]) | (shard[1:] != shard[:-1])]) if len(rows) else rows
            ends = np.r_[starts[1:], len(rows)]
            keep = spread[shard[starts]] > 0
            starts, ends = starts[keep], ends[keep]
            ids, ties = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)[rows[starts]] for c in (0, 2))
            salt = ((ids ^ ties).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard[starts]),
                    pa.array(salt % spread[shard[starts]]),
                    pa.array(np.ones(len(starts), np.int32)),
                    pa.array(ids),
                    pa.array(ties),
                    pa.array([both[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                ],
                names=["shard", "salt", "kind", "doc_id", "tie", "data"],
            )

    lines = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", "text", row_key())
    return mapped(lines, run, "shard long, salt long, kind int, doc_id long, tie long, data binary")


def _probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by shard and salt, the index before its probes; only one index is held."""
    index = None
    for batch in in_slices(batches):
        ids, ties, lines = [], [], []
        for kind, doc_id, tie, data in zip(*(batch.column(n).to_pylist() for n in ("kind", "doc_id", "tie", "data"))):
            if kind == 0:
                index = LineIndex.from_bytes(data)
                continue
            both = np.frombuffer(data, "<u8").reshape(-1, 2)
            lost = both[index.owners(both[:, 0], both[:, 1]) < doc_id]
            if len(lost):
                ids.append(doc_id)
                ties.append(tie)
                lines.append(lost.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(ties, pa.int64()), pa.array(lines, pa.binary())], names=["doc_id", "tie", "lost"]
        )


def lost_lines(docs: DataFrame) -> DataFrame:
    """doc_id, tie, lost: lists of hashes of the lines that a row (``row_key`` is tie) gives up; other rows have none."""
    spark = docs.sparkSession
    repeated = saved(repeated_lines(docs), "repeated-lines")
    total = repeated.count()
    shards = min(MAX_SHARDS, total // SHARD_LINES + 1)
    weights = {r[0]: r[1] for r in repeated.groupBy(_shard_column(shards).alias("shard")).agg(F.sum("documents")).collect()}
    groups, probes = GROUPS_PER_TASK * shuffle_tasks(spark), sum(weights.values())
    salts = {s: groups // shards + 1 + groups * w // probes for s, w in weights.items()}
    rows = _index_rows(repeated, shards, salts).unionByName(_probe_rows(docs, shards, salts))
    dealt = rows.repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    lost = mapped(dealt, _probed, "doc_id long, tie long, lost binary")
    return lost.groupBy("doc_id", "tie").agg(F.collect_set("lost").alias("lost"))


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with lines kept only in the smallest doc_id that holds them.

    Texts are split at line feeds. Lines are compared without blanks at both ends and
    with A-Z as a-z; keys under 10 code points stay everywhere. A null text becomes the
    empty text, one empty line. Adds n_lines (before) and n_dropped. Rows without a
    doc_id hold no line for others and keep all of theirs. Rows of one doc_id are one
    document: they never take lines from each other. Other columns pass through; columns
    of the names added are replaced. An empty table stays empty.
    """
    docs = docs.drop("n_lines", "n_dropped")
    names = docs.columns
    lost = lost_lines(docs).select(F.col("doc_id").alias("__doc_id"), F.col("tie").alias("__tie"), F.col("lost").alias("__lost"))
    same = (F.col("doc_id") == F.col("__doc_id")) & (row_key() == F.col("__tie"))
    joined = docs.join(lost, same, "left").drop("__doc_id", "__tie")
    joined = joined.select(*[c for c in names if c != "text"], "text", "__lost")
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema if f.name not in ("__lost",)), "n_lines long", "n_dropped long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            kept, n_lines, n_dropped = [], [], []
            for text, lost in zip(utf8(batch.column("text")), batch.column("__lost").to_pylist()):
                lines = text.split(b"\n")
                n_lines.append(len(lines))
                if lost:
                    gone = {part[i : i + 16] for part in lost for i in range(0, len(part), 16)}
                    stay = [line for line, h in zip(lines, line_hashes(text)) if h is None or h not in gone]
                    kept.append(b"\n".join(stay))
                    n_dropped.append(len(lines) - len(stay))
                else:
                    kept.append(text)
                    n_dropped.append(0)
            others = [n for n in batch.schema.names if n not in ("text", "__lost")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in others), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                names=[*others, "text", "n_lines", "n_dropped"],
            )

    return mapped(joined, run, ddl).select(*names, "n_lines", "n_dropped")
