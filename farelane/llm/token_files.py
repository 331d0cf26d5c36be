"""Raw token id files with keyed access through a minimal perfect hash.

A table of shards in ascending doc_id order. A shard holds the raw little-endian
unsigned 32-bit ids of its documents, and an index: a minimal perfect hash leads from a
document key to a slot with the key's fingerprint and the place of its ids in the shard.
Spark writes the shards, so a lost executor's shards are written again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.llm.chunk_encoder import SPACED, chunk_encoder
from farelane.llm.common import in_slices, mapped, row_key, texts
from farelane.llm.mph import MinimalPerfectHash, mixed

#: Ids per shard; a longer document fills a shard alone.
SHARD_IDS = 1 << 18
#: Keys of one call of read_keys; a longer list is refused, not cut.
MAX_KEYS = 100_000
PRINT_SEED = 1000

SHARDS = pa.schema(
    [
        ("part", pa.int64()), ("shard", pa.int64()), ("part_start", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
        ("first_key", pa.int64()), ("last_key", pa.int64()),
        ("keys", pa.binary()), ("key_null", pa.binary()), ("ends", pa.binary()),
        ("table", pa.binary()), ("prints", pa.binary()), ("places", pa.binary()), ("payload", pa.binary()),
    ]
)
SHARDS_DDL = (
    "part long, shard long, part_start long, n_docs long, n_ids long, first_key long, last_key long, "
    "keys binary, key_null binary, ends binary, table binary, prints binary, places binary, payload binary"
)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys.view(np.uint64), PRINT_SEED) >> np.uint64(32)).astype(np.uint32)


def _shard(part: int, shard: int, start: int, keys: list, ids: list[np.ndarray]) -> dict:
    null = np.array([k is None for k in keys], bool)
    whole = np.array([0 if k is None else k for k in keys], np.int64)
    distinct, place = np.unique(whole[~null], return_index=True)
    place += int(null.sum())  # rows without a key come first
    table = MinimalPerfectHash.build(distinct.view(np.uint64))
    order = np.argsort(table.slots(distinct.view(np.uint64)))
    payload = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    return {
        "part": part, "shard": shard, "part_start": start, "n_docs": len(keys), "n_ids": len(payload),
        "first_key": int(distinct[0]) if len(distinct) else None, "last_key": int(distinct[-1]) if len(distinct) else None,
        "keys": whole.astype("<i8").tobytes(), "key_null": null.tobytes(),
        "ends": np.cumsum([len(i) for i in ids]).astype("<i8").tobytes(),
        "table": table.to_bytes(), "prints": fingerprints(distinct[order]).astype("<u4").tobytes(),
        "places": place[order].astype("<i8").tobytes(), "payload": payload.astype("<u4").tobytes(),
    }


class Shard:
    """A shard as read back."""

    def __init__(self, row: dict):
        self.start = row["part_start"]
        self.keys = np.frombuffer(row["keys"], "<i8")
        self.key_null = np.frombuffer(row["key_null"], bool)
        self.ends = np.frombuffer(row["ends"], "<i8")
        self.table = MinimalPerfectHash.from_bytes(row["table"])
        self.prints = np.frombuffer(row["prints"], "<u4")
        self.places = np.frombuffer(row["places"], "<i8")
        self.payload = np.frombuffer(row["payload"], "<u4")

    def rows_of(self, keys: np.ndarray) -> np.ndarray:
        """The first row of every key in this shard, -1 where it has none: one probe and one fingerprint each."""
        slots = self.table.slots(keys.view(np.uint64))
        known = slots >= 0
        known[known] = self.prints[slots[known]] == fingerprints(keys[known])
        rows = np.full(len(keys), -1, np.int64)
        rows[known] = self.places[slots[known]]
        return rows

    def ids(self, row: int) -> np.ndarray:
        return self.payload[self.ends[row - 1] if row else 0 : self.ends[row]]


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int, shard_ids: int = SHARD_IDS) -> None:
    """Writes the ids of every text, ``end_id`` after each, in ascending doc_id order.

    A null text counts as empty and has the end id alone. Rows without a doc_id come
    first and have no key. Rows of one doc_id lie side by side, equal texts too, in the
    order of a hash of their texts. Other columns are left out. An empty table gives an
    empty folder of files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = chunk_encoder(path, SPACED), TaskContext.get().partitionId()
        keys: list = []
        ids: list[np.ndarray] = []
        start = held = shard = 0
        end = np.array([end_id], np.uint32)
        for batch in in_slices(batches, 128):
            for key, found in zip(batch.column(0).to_pylist(), encoder.encode(texts(batch.column(1)))):
                if keys and held + len(found) + 1 > shard_ids:
                    yield pa.RecordBatch.from_pylist([_shard(part, shard, start, keys, ids)], schema=SHARDS)
                    start, held, shard, keys, ids = start + held, 0, shard + 1, [], []
                keys.append(key)
                ids += [np.concatenate([found, end])]
                held += len(found) + 1
        if keys:
            yield pa.RecordBatch.from_pylist([_shard(part, shard, start, keys, ids)], schema=SHARDS)

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", row_key().alias("tie"))
        .repartitionByRange(F.asc_nulls_first("doc_id"), "tie")
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), "tie")
        .select("doc_id", "text")
    )
    mapped(ordered, run, SHARDS_DDL).write.option("compression", "zstd").parquet(folder)


def part_starts(spark: SparkSession, folder: str) -> dict[int, int]:
    """Ids before each written part: one number per task that wrote, whatever the number of documents."""
    sizes = spark.read.schema(SHARDS_DDL).parquet(folder).groupBy("part").agg(F.sum("n_ids")).collect()
    starts, before = {}, 0
    for part, size in sorted(tuple(r) for r in sizes):
        starts[part] = before
        before += size
    return starts


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, each found through its shard's index."""
    starts = part_starts(spark, folder)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 1):
            row = batch.to_pylist()[0]
            shard, base = Shard(row), starts[row["part"]]
            rows = shard.rows_of(shard.keys)
            # A key leads to its first row; rows of a repeated or missing key follow by their place.
            repeats = shard.key_null | np.r_[False, shard.keys[1:] == shard.keys[:-1]]
            rows = np.where(repeats, np.arange(len(rows)), rows)
            if (rows < 0).any():
                raise ValueError("an index lacks a key of its shard")
            found = [shard.ids(r) for r in rows]
            lengths = np.array([len(i) for i in found], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard.keys, pa.int64(), mask=shard.key_null),
                    pa.array(base + shard.start + shard.ends[rows] - lengths),
                    pa.array(lengths),
                    pa.array([zlib.crc32(i.tobytes()) for i in found], pa.int64()),
                ],
                schema=schema,
            )

    shards = spark.read.schema(SHARDS_DDL).parquet(folder)
    return mapped(shards, run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_keys(spark: SparkSession, folder: str, keys: list[int]) -> DataFrame:
    """doc_id, ids of the listed keys: shards outside their range are skipped, others probed once per key."""
    if len(keys) > MAX_KEYS:
        raise ValueError(f"at most {MAX_KEYS} keys per call")
    wanted = np.unique(np.array(keys, np.int64))
    low, high = (int(wanted[0]), int(wanted[-1])) if len(wanted) else (1, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 1):
            row = batch.to_pylist()[0]
            shard, near = Shard(row), wanted[(wanted >= row["first_key"]) & (wanted <= row["last_key"])]
            rows = shard.rows_of(near)
            found = []
            for key, first in zip(near[rows >= 0].tolist(), rows[rows >= 0].tolist()):
                while first < len(shard.keys) and shard.keys[first] == key:
                    found.append((key, shard.ids(first).astype(np.int64)))
                    first += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in found], pa.int64()), pa.array([i for _, i in found], pa.list_(pa.int64()))],
                names=["doc_id", "ids"],
            )

    shards = spark.read.schema(SHARDS_DDL).parquet(folder).filter((F.col("first_key") <= high) & (F.col("last_key") >= low))
    return mapped(shards, run, "doc_id long, ids array<long>")
