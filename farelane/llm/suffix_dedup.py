"""Removal of byte strings that earlier documents hold too, by a distributed merge sort of suffixes.

Texts are packed into runs. A run first sends fingerprints of its anchors to slices, which
answer with those that other runs have too. Of the anchors left it sorts the suffixes, and sends
every slice a front-coded sorted run of them. A slice merges its runs with a loser tree; strings
of SPAN bytes that are equal are then neighbours, and runs learn the smallest document of each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import flat_ranges, in_slices, mapped, saved, shuffle_tasks, utf8
from farelane.llm.suffix_runs import PLACES, SPAN, AnchoredTexts, Entries, pack_numbers, smallest_by_place, unpack_numbers

#: Bytes of text in a run; a longer text is a run of its own.
RUN_BYTES = 8 << 20
#: Runs whose suffixes make up one slice, if every suffix is repeated.
RUNS_PER_SLICE = 2
#: Bytes of entries that wait to be sent.
SENT_BYTES = 1 << 20

RUNS_DDL = "run long, kind int, slice int, data binary"
RUNS = pa.schema([("run", pa.int64()), ("kind", pa.int32()), ("slice", pa.int32()), ("data", pa.binary())])
TEXTS, PRINTS, REPEATED, ENTRIES, PLACED, SMALLER = range(6)
NO_ID = np.iinfo(np.int64).max


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(zip(*rows), RUNS)] if rows else [pa.array([], t.type) for t in RUNS], schema=RUNS)


def _joined(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def _parted(data: bytes) -> list[bytes]:
    parts, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at : at + 8], "little")
        parts.append(data[at + 8 : at + 8 + size])
        at += 8 + size
    return parts


def _packed_texts(run_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, 0
        ids: list = []
        texts: list[bytes] = []

        def row() -> pa.RecordBatch:
            nulls = np.array([i is None for i in ids], bool)
            whole = np.array([NO_ID if i is None else i for i in ids], "<i8")
            sizes = np.array([len(t) for t in texts], "<i8")
            body = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            return _rows([((part << 32) + number, TEXTS, 0, _joined(pack_numbers(whole), nulls.tobytes(), pack_numbers(sizes), body))])

        for batch in in_slices(batches, 64):
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                if texts and held + len(text) > run_bytes:
                    yield row()
                    number, held, ids, texts = number + 1, 0, [], []
                ids.append(doc_id)
                texts.append(text)
                held += len(text)
        if texts:
            yield row()

    return run


def _read_texts(data: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """Ids, rows without an id, texts, and where each ends."""
    ids, nulls, sizes, body = _parted(data)
    nulls, ends = np.frombuffer(nulls, bool), np.cumsum(unpack_numbers(sizes, "<i8"))
    joined = zstandard.ZstdDecompressor().decompress(body)
    edges = ends.tolist()
    return unpack_numbers(ids, "<i8"), nulls, [joined[a:b] for a, b in zip([0, *edges], edges)], ends


def _anchored(data: bytes) -> tuple[np.ndarray, AnchoredTexts]:
    """Ids, and texts with their anchors."""
    ids, nulls, texts, _ = _read_texts(data)
    return ids, AnchoredTexts(texts, ~nulls)


def _by_slice(slices: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(slices, kind="stable")
    heads = np.flatnonzero(np.r_[True, np.diff(slices[order]) != 0]) if len(order) else order
    for a, b in zip(heads, np.r_[heads[1:], len(order)]):
        yield int(slices[order[a]]), order[a:b]


def _prints(slices: int):
    """PRINTS rows: the distinct fingerprints of a run, ascending, as differences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 1):
            row = batch.to_pylist()[0]
            dealt, prints = _anchored(row["data"])[1].fingerprints(slices)
            yield _rows([(row["run"], PRINTS, s, pack_numbers(np.diff(np.unique(prints[o]), prepend=np.uint32(0)))) for s, o in _by_slice(dealt)])

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """REPEATED rows: for each run's fingerprints one bit, whether another run has them too. Rows come by slice."""
    held: list[dict] = []

    def answer() -> pa.RecordBatch:
        prints = [np.cumsum(unpack_numbers(r["data"], "<u4"), dtype=np.uint32) for r in held]
        every, count = np.unique(np.concatenate(prints), return_counts=True)
        several = every[count > 1]
        return _rows([(r["run"], REPEATED, r["slice"], np.packbits(np.isin(p, several, assume_unique=True)).tobytes()) for r, p in zip(held, prints)])

    for batch in in_slices(batches, 64):
        for row in batch.to_pylist():
            if held and held[0]["slice"] != row["slice"]:
                yield answer()
                held = []
            held.append(row)
    if held:
        yield answer()


def _by_run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[int, list[dict]]]:
    """The rows of one run after another, by kind."""
    held: dict[int, list[dict]] = {}
    number = None
    for batch in in_slices(batches, 16):
        for row in batch.to_pylist():
            if held and row["run"] != number:
                yield held
                held = {}
            number = row["run"]
            held.setdefault(row["kind"], []).append(row)
    if held:
        yield held


def _entries(slices: int):
    """ENTRIES rows for the slices, and PLACED rows that say where the entries occur; rows come by run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_run(batches):
            number = rows[TEXTS][0]["run"]
            ids, texts = _anchored(rows[TEXTS][0]["data"])
            dealt, prints = texts.fingerprints(slices)
            bits = {r["slice"]: r["data"] for r in rows.get(REPEATED, [])}
            out, held = [], 0
            for s, of_slice in _by_slice(dealt):
                distinct, which, count = np.unique(prints[of_slice], return_inverse=True, return_counts=True)
                known = np.unpackbits(np.frombuffer(bits[s], np.uint8), count=len(distinct)).astype(bool)
                chosen = of_slice[(known | (count > 1))[which]]
                if not len(chosen):
                    continue
                entries, entry = Entries.of(texts, chosen, ids)
                in_order = np.argsort(chosen, kind="stable")
                places = [entry[in_order], np.diff(texts.begin[chosen][in_order], prepend=0), texts.anchor[chosen][in_order] - texts.begin[chosen][in_order], texts.last[chosen][in_order] - texts.begin[chosen][in_order]]
                kinds = ("<u4", "<i8", "<u1", "<u1")
                out.append((number, ENTRIES, s, entries.to_bytes()))
                out.append((number, PLACED, s, _joined(*(pack_numbers(p.astype(k)) for p, k in zip(places, kinds)), pack_numbers(entries.smallest.astype("<i8")))))
                held += len(out[-1][3]) + len(out[-2][3])
                if held > SENT_BYTES:
                    yield _rows(out)
                    out, held = [], 0
            yield _rows(out)

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SMALLER rows: entry, range of places and smallest document where it is not the run's own. ENTRIES come by slice, others pass."""
    held: list[dict] = []

    def answer() -> pa.RecordBatch:
        runs = [Entries.from_bytes(r.pop("data")) for r in held]
        firsts = np.cumsum([0] + [len(r.right) for r in runs])
        found = [(f[0].astype("<u4"), *f[1:]) for f in smallest_by_place(runs)]
        del runs
        if not found:
            return _rows([])
        found = [np.concatenate(f) for f in zip(*found)]
        order = np.argsort(found[0], kind="stable")
        entry, place, more, least = (found.pop(0)[order] for _ in range(4))
        cuts = np.searchsorted(entry, firsts)
        out = []
        for row, first, a, b in zip(held, firsts.tolist(), cuts.tolist(), cuts[1:].tolist()):
            if b > a:
                parts = (np.diff(entry[a:b], prepend=np.uint32(first)), place[a:b], more[a:b], least[a:b].astype("<i8"))
                out.append((row["run"], SMALLER, row["slice"], _joined(*map(pack_numbers, parts))))
        return _rows(out)

    for batch in in_slices(batches, 64):
        passed = []
        for row in batch.to_pylist():
            if row["kind"] != ENTRIES:
                passed.append(tuple(row[n] for n in RUNS.names))
                continue
            if held and held[0]["slice"] != row["slice"]:
                yield answer()
                held = []
            held.append(row)
        if passed:
            yield _rows(passed)
    if held:
        yield answer()


def _covered(ends: np.ndarray, ids: np.ndarray, placed: list[dict], smaller: list[dict]) -> np.ndarray:
    """Which bytes of a run lie in a string that a smaller document holds."""
    edges = np.zeros(int(ends[-1]) + 1, np.int32)
    answers = {r["slice"]: _parted(r["data"]) for r in smaller}
    for row in placed:
        entry, begin, before, more, own = (unpack_numbers(p, k) for p, k in zip(_parted(row["data"]), ("<u4", "<i8", "<u1", "<u1", "<i8")))
        begin, before, entry = np.cumsum(begin), before.astype(np.int64), entry.astype(np.int64)
        doc = ids[np.searchsorted(ends, begin, side="right")]
        strings = more.astype(np.int64) + 1
        least = own[entry]
        local = least < doc
        # All strings of an entry that occurs under a smaller document of the run itself.
        np.add.at(edges, begin[local], 1)
        np.add.at(edges, (begin + strings - 1 + SPAN)[local], -1)
        if row["slice"] not in answers:
            continue
        which, place, more, found = (unpack_numbers(p, k) for p, k in zip(answers[row["slice"]], ("<u4", "<u1", "<u1", "<i8")))
        places = more.astype(np.int64) + 1
        table = np.full((len(own), PLACES), NO_ID)
        table[np.repeat(np.cumsum(which), places), flat_ranges(place.astype(np.int64), places)] = np.repeat(found, places)
        open_ = np.flatnonzero(~local)
        string = flat_ranges(np.zeros(len(open_), np.int64), strings[open_])
        of = np.repeat(open_, strings[open_])
        hit = table[entry[of], before[of] - string] < doc[of]
        at = (begin[of] + string)[hit]
        np.add.at(edges, at, 1)
        np.add.at(edges, at + SPAN, -1)
    return np.cumsum(edges[:-1], dtype=np.int32) > 0


KEPT_DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<long>, kept binary"
KEPT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("spans", pa.list_(pa.int64())), ("kept", pa.binary())])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of a run without the bytes covered; rows come by run."""
    for rows in _by_run(batches):
        ids, nulls, texts, ends = _read_texts(rows[TEXTS][0]["data"])
        covered = _covered(ends, ids, rows.get(PLACED, []), rows.get(SMALLER, []))
        out = []
        for i, (text, end) in enumerate(zip(texts, ends.tolist())):
            gone = covered[end - len(text) : end]
            edges = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if len(edges) else text
            out.append({"doc_id": None if nulls[i] else int(ids[i]), "n_bytes": len(text), "n_removed": len(text) - len(kept), "n_spans": len(edges) // 2, "spans": edges.tolist(), "kept": kept})
            if len(out) == 512:
                yield pa.RecordBatch.from_pylist(out, schema=KEPT)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=KEPT)


def drop_repeated_strings(docs: DataFrame, run_bytes: int = RUN_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans, kept: texts without strings of smaller documents.

    Every byte goes that lies in a string of SPAN bytes which also starts in a row of a smaller
    doc_id. Strings are judged on the texts as given. ``spans`` lists start and end of each run
    of bytes removed, ``kept`` the bytes left, which may part a character. A null text counts as
    empty; shorter texts stay. Rows of one doc_id never take strings from each other, so equal
    rows both stay or both go. Rows without a doc_id keep their text and hold no string for
    others. Other columns are left out; an empty table gives no row.

    Hot strings: a run sends each distinct entry once with its smallest document, however many
    of its documents hold it; where an entry occurs stays with the run.
    """
    spark = docs.sparkSession
    packed = mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _packed_texts(run_bytes), RUNS_DDL)
    runs = saved(packed, "suffix-texts")
    total = runs.count()
    slices = max(min(total, shuffle_tasks(spark)), total // RUNS_PER_SLICE, 1)
    prints = mapped(runs, _prints(slices), RUNS_DDL).repartition(slices, "slice").sortWithinPartitions("slice")
    asked = runs.unionByName(mapped(prints, _repeated, RUNS_DDL))
    entries = mapped(asked.repartition("run").sortWithinPartitions("run", "kind"), _entries(slices), RUNS_DDL)
    home = F.when(F.col("kind") == ENTRIES, F.col("slice").cast("long")).otherwise(-1 - F.col("run"))
    # A task's rows may be one Arrow batch, so few slices should meet in one task.
    dealt = entries.withColumn("home", home).repartition(4 * slices, "home").sortWithinPartitions("home").drop("home")
    answers = runs.unionByName(mapped(dealt, _merged, RUNS_DDL))
    return mapped(answers.repartition("run").sortWithinPartitions("run", "kind"), _kept, KEPT_DDL)
