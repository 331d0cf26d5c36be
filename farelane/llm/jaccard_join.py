"""Exact Jaccard join of word shingle sets as components: a grouped prefix join.

Shingles are ordered from rare to common. Two sets that reach the threshold share a
shingle among the first quarter of both, their prefixes. Documents of equal sets are one
member, and members of identical prefixes and size are one group: the prefix is posted
once for all of them. Group pairs that share a prefix shingle are filtered, then expanded
to members, whose whole sets are verified. This is done twice. First each group's head
is compared with the members of its own group and of the groups for which it holds a
shared shingle earliest. Then group pairs that still reach into different components are
filtered by size, places and bitmaps of their prefixes, and their members in different
components are compared. Pairs inside a component need no check.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import in_slices, mapped, row_key, saved, ship_package, shuffle_tasks, utf8
from farelane.llm.components import components
from farelane.llm.mph import mixed

WORDS = 5
#: Two sets link when 100 * intersection >= PERCENT * union, as whole numbers.
PERCENT = 75
#: Shingles of known frequency at most, 12 bytes each in every task; all others count as rare.
KNOWN = 1 << 20
MIN_KNOWN = 4
#: Beyond this many documents a shingle's postings are dealt by group instead of by shingle.
HOT = 4096
#: Shingles counted, and postings compared, per task group.
COUNTED, POSTED = 1 << 21, 1 << 19
#: Sets compared with one copy of a centre's set.
MEMBERS = 64

STEP = np.uint64(0x9E3779B97F4A7C15)
POSTING = np.dtype([("token", "<u8"), ("group", "<i8"), ("size", "<u4"), ("place", "<u4")])
MEMBER = np.dtype([("group", "<i8"), ("member", "<i8")])
#: Words of 64 bits in the bitmap of a prefix.
BITMAP = 4
#: Sets and groups that a task remembers to send them once; sending one again changes nothing.
SEEN = 1 << 17


def shingles(text: bytes) -> np.ndarray:
    """Distinct hashes of all runs of five words, ascending; of the whole text if it has fewer."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    rolled = hashes[: len(words) - width + 1].copy()
    for k in range(1, width):
        rolled = mixed(rolled, k) + hashes[k : len(words) - width + 1 + k] * STEP
    return np.unique(mixed(rolled, width))


def member_of(found: np.ndarray) -> int:
    """Names a set: documents of equal sets get the same number."""
    return xxhash.xxh3_64_intdigest(found.tobytes(), seed=len(found)) - (1 << 63)


def group_of(prefix: np.ndarray, size: int) -> int:
    """Names a group: sets of the same prefix and size get the same number."""
    return xxhash.xxh3_64_intdigest(prefix.tobytes(), seed=size) - (1 << 63)


def prefix_length(size: int) -> int:
    """Two sets without a common shingle among so many of their first ones cannot link."""
    return size - (PERCENT * size + 99) // 100 + 1


def _counter(tokens: np.ndarray, shards: int) -> np.ndarray:
    """A shingle's shard and 32 of its bits: enough to estimate its frequency."""
    return (((tokens >> np.uint64(40)) % np.uint64(shards)) << np.uint64(32)) | (tokens & np.uint64(0xFFFFFFFF))


def _packed_ascending(low: np.ndarray) -> bytes:
    """Ascending numbers as differences, by planes of bytes, compressed: about half of their four bytes."""
    steps = np.diff(low, prepend=np.uint32(0)).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes())


def _ascending(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def _described(docs: DataFrame, shards: int) -> DataFrame:
    """Rows of two kinds: a document's set and its size, or the counters of many documents packed by shard."""
    ddl = "doc_id long, tie long, member long, size long, shard long, data binary"

    def packed(counters: list[np.ndarray]) -> pa.RecordBatch:
        found = np.sort(np.concatenate(counters))
        shard = (found >> np.uint64(32)).astype(np.int64)
        low = found.astype("<u4")
        names, starts = np.unique(shard, return_index=True)
        ends = np.r_[starts[1:], len(found)]
        blank = pa.nulls(len(names), pa.int64())
        data = pa.array([_packed_ascending(low[a:b]) for a, b in zip(starts, ends)], pa.binary())
        return pa.RecordBatch.from_arrays([blank] * 4 + [pa.array(names), data], names=NAMES)

    NAMES = [part.split()[0] for part in ddl.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, held = [], 0
        for batch in in_slices(batches):
            sets = [shingles(text) for text in utf8(batch.column(1))]
            n = len(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2), pa.array([member_of(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()),
                ],
                names=NAMES,
            )
            for found in sets:
                counters.append(_counter(found, shards))
                held += len(found)
            if held >= COUNTED:
                yield packed(counters)
                counters, held = [], 0
        if held:
            yield packed(counters)

    return mapped(docs.select(F.col("doc_id").cast("long"), "text", row_key()), run, ddl)


def _frequencies(counters: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent counters, at most KNOWN, and their numbers of documents, both by counter."""

    def count(key: tuple, table: pa.Table) -> pa.Table:
        low = np.concatenate([_ascending(d) for d in table.column("data").to_pylist()])
        found, times = np.unique(low, return_counts=True)
        often = times >= MIN_KNOWN
        names = (np.uint64(key[0].as_py()) << np.uint64(32)) | found[often].astype(np.uint64)
        return pa.table({"counter": names.view(np.int64), "times": times[often].astype(np.int64)})

    found = saved(counters.groupBy("shard").applyInArrow(count, "counter long, times long"), "frequencies")
    steps = found.groupBy(F.floor(F.log2("times") * 8).alias("step")).count().orderBy(F.desc("step")).collect()
    total, least = 0, None
    for step, n in steps:
        total += n
        if total > KNOWN:
            break
        least = step
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    known = found.filter(F.floor(F.log2("times") * 8) >= least).toArrow()
    names = known.column("counter").to_numpy().view(np.uint64)
    order = np.argsort(names)
    return names[order], known.column("times").to_numpy().astype(np.uint32)[order]


def _postings(docs: DataFrame, known: tuple[np.ndarray, np.ndarray], counted: int, shards: int) -> DataFrame:
    """Rows of two kinds: token, group, size, place of prefix shingles; or group, member of every set.

    Shingles that one group alone posts are left out, but for hot ones.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(known)

    def packed(parts: list[np.ndarray], hot: list[np.ndarray], sets: list[tuple[int, int]]) -> pa.RecordBatch:
        members = np.array(sets, MEMBER)
        rows = np.concatenate([np.empty(0, POSTING), *parts])
        often = np.concatenate([np.empty(0, bool), *hot])
        dealt = np.where(often, rows["group"].view(np.uint64), rows["token"])
        kinds = [
            (rows, (mixed(dealt, 7) % np.uint64(shards)).astype(np.int64) + shards * often),
            (members, (mixed(members["group"].view(np.uint64), 7) % np.uint64(shards)).astype(np.int64) + 2 * shards),
        ]
        shard_names, data = [], []
        for found, shard in kinds:
            order = np.argsort(shard, kind="stable")
            found, shard = found[order], shard[order]
            names, starts = np.unique(shard, return_index=True)
            ends = np.r_[starts[1:], len(found)]
            shard_names += names.tolist()
            data += [b"".join(found[f][a:b].tobytes() for f in found.dtype.names) for a, b in zip(starts, ends)]
        return pa.RecordBatch.from_arrays([pa.array(shard_names, pa.int64()), pa.array(data, pa.binary())], names=["shard", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, times = shared.value
        parts, hot, sets, held, seen, posted = [], [], [], 0, set(), set()
        for batch in in_slices(batches):
            for text in utf8(batch.column(0)):
                found = shingles(text)
                member = member_of(found)
                if not len(found) or member in seen:
                    continue
                seen.add(member)
                counter = _counter(found, counted)
                at = np.searchsorted(names, counter)
                at[at == len(names)] = 0
                often = np.where(names[at] == counter, times[at], 0) if len(names) else np.zeros(len(found), np.uint32)
                first = np.argsort(often, kind="stable")[: prefix_length(len(found))]
                group = group_of(found[first], len(found))
                sets.append((group, member))
                held += 1
                if group in posted:
                    continue
                posted.add(group)
                rows = np.empty(len(first), POSTING)
                rows["token"], rows["group"], rows["size"] = found[first], group, len(found)
                rows["place"] = np.arange(len(first))
                parts.append(rows)
                hot.append(often[first] >= HOT)
                held += len(rows)
            if held >= POSTED:
                yield packed(parts, hot, sets)
                parts, hot, sets, held = [], [], [], 0
            if len(seen) > SEEN:
                seen, posted = set(), set()
        if held:
            yield packed(parts, hot, sets)

    def unpacked(pieces: list[bytes], kind: np.dtype) -> np.ndarray:
        made = []
        for data in pieces:
            n, at = len(data) // kind.itemsize, 0
            rows = np.empty(n, kind)
            for field in kind.names:
                rows[field] = np.frombuffer(data, kind[field], n, at)
                at += n * kind[field].itemsize
            made.append(rows)
        return np.concatenate(made)

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        shard, pieces = key[0].as_py(), table.column("data").to_pylist()
        if shard >= 2 * shards:
            rows = np.unique(unpacked(pieces, MEMBER))
            blank = pa.nulls(len(rows), pa.int64())
            columns = [blank, pa.array(rows["group"].copy()), blank, blank, pa.array(rows["member"].copy())]
            return pa.table(columns, names=["token", "group", "size", "place", "member"])
        rows = unpacked(pieces, POSTING)
        order = np.lexsort((rows["group"], rows["token"]))
        token, group = rows["token"][order], rows["group"][order]
        new_token = np.r_[True, token[1:] != token[:-1]]
        distinct = new_token | np.r_[True, group[1:] != group[:-1]]
        order, token, new_token = order[distinct], token[distinct], np.r_[True, token[distinct][1:] != token[distinct][:-1]]
        if shard < shards:
            starts = np.flatnonzero(new_token)
            sizes = np.diff(np.r_[starts, len(token)])
            order = order[np.repeat(sizes > 1, sizes)]
        rows = rows[order]
        return pa.table({
            "token": rows["token"].view(np.int64), "group": rows["group"].copy(), "size": rows["size"].astype(np.int64),
            "place": rows["place"].astype(np.int64), "member": pa.nulls(len(rows), pa.int64()),
        })

    dealt = mapped(docs.select("text"), run, "shard long, data binary")
    return dealt.groupBy("shard").applyInArrow(meet, "token long, group long, size long, place long, member long")


def _sizes_fit(a: str, b: str):
    return 100 * F.least(f"{a}.size", f"{b}.size") >= PERCENT * F.greatest(f"{a}.size", f"{b}.size")


def _left(a: str, b: str):
    """Shingles from a shared one on, of the set that has fewer."""
    return F.least(F.col(f"{a}.size") - F.col(f"{a}.place"), F.col(f"{b}.size") - F.col(f"{b}.place"))


def _enough(common, sizes):
    """Whether so many common shingles can reach the threshold in sets of together ``sizes``."""
    return (100 + PERCENT) * common >= PERCENT * sizes


def _star_pairs(postings: DataFrame, members: DataFrame) -> DataFrame:
    """Heads of groups with the members of their group, and of groups in which a shingle of theirs stands later."""
    first = postings.groupBy("token").agg(
        F.min(F.struct("place", "group", "size")).alias("c"), F.min("group").alias("low"), F.max("group").alias("high")
    )
    first = first.filter("low < high").select("token", "c.*")
    pairs = postings.alias("m").join(first.alias("c"), F.col("m.token") == F.col("c.token"))
    sizes = F.col("m.size") + F.col("c.size")
    pairs = pairs.filter((F.col("m.group") != F.col("c.group")) & _sizes_fit("m", "c") & _enough(_left("m", "c"), sizes))
    pairs = pairs.select(F.col("c.group").alias("first"), F.col("m.group").alias("group")).distinct()
    heads = members.groupBy(F.col("group").alias("first")).agg(F.min("member").alias("a"))
    across = pairs.join(heads, "first").join(members, "group").select("a", F.col("member").alias("b"))
    within = members.join(heads, F.col("group") == F.col("first")).select("a", F.col("member").alias("b"))
    return across.union(within.filter("a != b"))


def _open_groups(postings: DataFrame, spans: DataFrame) -> DataFrame:
    """Pairs a, b of groups that may link and reach into different components, a group with itself included.

    Of two linked sets, the common shingles that do not lie in both prefixes all lie behind one of
    them, so the prefixes must share many. A bitmap of a prefix holds a bit for every place that an
    odd number of its shingles falls on: bits that differ are at most the shingles that differ, so
    the bitmaps tell most pairs apart before they are written, and never a pair that links.
    """
    spread = postings.join(spans, "group")
    tokens = spread.groupBy("token").agg(F.min("low").alias("l"), F.max("high").alias("h"), F.count("*").alias("n"))
    tokens = tokens.filter("l < h").select("token", F.floor(F.col("n") / HOT).alias("parts"))
    rows = saved(spread.join(tokens, "token"), "open-postings")
    place = F.pmod(F.xxhash64("token"), F.lit(64 * BITMAP))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))
    bitmap = [F.bit_xor(F.when(F.floor(place / 64) == i, bit).otherwise(F.lit(0).cast("long"))).alias(f"bits{i}") for i in range(BITMAP)]
    rows = rows.join(rows.groupBy("group").agg(F.count("*").alias("shared"), *bitmap), "group")
    # A shingle of many groups is compared in parts: one side is dealt, the other sent to every part.
    left = rows.withColumn("part", F.pmod(F.xxhash64("group"), F.col("parts") + 1)).alias("m")
    right = rows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts")))).alias("c")
    met = (F.col("m.token") == F.col("c.token")) & (F.col("m.part") == F.col("c.part")) & (F.col("m.group") < F.col("c.group"))
    differ = F.least("m.low", "c.low") < F.greatest("m.high", "c.high")
    sizes = F.col("m.size") + F.col("c.size")
    unlike = sum((F.bit_count(F.col(f"m.bits{i}").bitwiseXOR(F.col(f"c.bits{i}"))) for i in range(BITMAP)), F.lit(0))
    behind = F.greatest(*(F.ceil(PERCENT * F.col(f"{x}.size") / 100) - 1 for x in "mc"))
    twice = F.col("m.shared") + F.col("c.shared") - unlike + 2 * behind
    pairs = left.join(right, met & differ & _sizes_fit("m", "c") & _enough(_left("m", "c"), sizes) & _enough(twice, 2 * sizes))
    pairs = pairs.select(F.col("m.group").alias("a"), F.col("c.group").alias("b")).distinct()
    return pairs.union(spans.filter("low < high").select(F.col("group").alias("a"), F.col("group").alias("b")))


def _open_pairs(postings: DataFrame, members: DataFrame, labels: DataFrame, tested: DataFrame) -> DataFrame:
    """Members of open groups that stand in different components and were not tested."""
    labelled = members.join(labels, F.col("member") == F.col("node"), "left")
    labelled = saved(labelled.select("group", "member", F.coalesce("component", "member").alias("label")), "member-labels")
    spans = labelled.groupBy("group").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    groups = saved(_open_groups(postings, spans), "open-groups")
    x, y = labelled.alias("x"), labelled.alias("y")
    pairs = groups.join(x, F.col("a") == F.col("x.group")).join(y, F.col("b") == F.col("y.group"))
    once = (F.col("a") < F.col("b")) | (F.col("x.member") < F.col("y.member"))
    pairs = pairs.filter((F.col("x.label") != F.col("y.label")) & once)
    pairs = pairs.select(F.col("x.member").alias("a"), F.col("y.member").alias("b"))
    both = tested.select("a", "b").union(tested.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return pairs.join(both, ["a", "b"], "left_anti")


def _verified(docs: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs a, b whose whole sets link. Each set is made again from one of its texts."""
    stars = pairs.groupBy("a").agg(F.count("*").alias("n"))
    salts = (F.col("n") / MEMBERS).cast("long") + 1
    members = pairs.join(stars, "a").select(
        "a", F.pmod(F.xxhash64("b"), salts).alias("salt"), F.lit(1).alias("kind"), F.col("b").alias("member")
    )
    centres = stars.select(
        "a", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt"), F.lit(0).alias("kind"), F.col("a").alias("member")
    )
    roles = saved(members.union(centres).join(sets, "member"), "roles")
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc"), "text", row_key().alias("key"))
    chosen = chosen.join(roles, F.col("doc").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("tie")))
    ddl = "a long, salt long, kind int, member long, data binary"

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            data, last, last_text = [], b"", None
            for text in utf8(batch.column(4)):
                if text != last_text:
                    last, last_text = shingles(text).tobytes(), text
                data.append(last)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(data, pa.binary())], names=[*batch.schema.names[:4], "data"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = None
        for batch in in_slices(batches):
            a, b = [], []
            for star, kind, member, data in zip(*(batch.column(n).to_pylist() for n in ("a", "kind", "member", "data"))):
                found = np.frombuffer(data, "<u8")
                if kind == 0:
                    centre = found
                    continue
                at = np.searchsorted(centre, found)
                at[at == len(centre)] = 0
                common = int((centre[at] == found).sum())
                if 100 * common >= PERCENT * (len(centre) + len(found) - common):
                    a.append(star)
                    b.append(member)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    made = mapped(chosen.select("a", "salt", "kind", "member", "text"), again, ddl)
    dealt = made.repartition("a", "salt").sortWithinPartitions("a", "salt", "kind")
    return mapped(dealt, compare, "a long, b long")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``.

    Texts are compared as sets of five-word shingles with A-Z as a-z; a text of fewer
    words is one shingle, a text without words or a null text has none and links with
    nothing. component_id is the smallest doc_id that links lead to, the row's own
    included. Rows of one doc_id are compared by their texts like any others. A row
    without a doc_id links too, but never names a component; without any named row in
    its component its component_id is null. Other columns are left out, and an empty
    table gives an empty one.
    """
    return _named(*_linked(docs))


def linked_rows(docs: DataFrame) -> DataFrame:
    """id, text_hash (``row_key``), component for every row of ``docs`` with words; rows of one component link."""
    rows, sets, labels = _linked(docs)
    labelled = sets.join(labels, F.col("member") == F.col("node"), "left")
    labelled = labelled.select(F.col("member").alias("of"), F.coalesce("component", "member").alias("label"))
    joined = rows.filter("size > 0").join(labelled, F.col("member") == F.col("of"))
    return joined.select(F.col("doc_id").alias("id"), F.col("tie").alias("text_hash"), F.col("label").alias("component"))


def _linked(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with their set, sets with one row of each, and components of linked sets."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select("doc_id", "text")
    words = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(shuffle_tasks(spark), words // 6 // COUNTED + 1)
    described = saved(_described(docs, shards), "shingles")
    rows = described.filter("shard is null").select("doc_id", "tie", "member", "size")
    known = _frequencies(described.filter("shard is not null").select("shard", "data"))
    filled = rows.filter("size > 0")
    sets = filled.groupBy("member").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tie")).alias("r"))
    sets = saved(sets.select("member", "r.doc_id", "r.tie"), "sets")
    total = filled.agg(F.sum("size")).first()[0] or 0
    posted = saved(_postings(docs, known, shards, max(shuffle_tasks(spark), prefix_length(total) // POSTED + 1)), "postings")
    postings = posted.filter("token is not null").select("token", "group", "size", "place")
    members = posted.filter("member is not null").select("group", "member")
    tested = saved(_star_pairs(postings, members), "star-pairs")
    links = saved(_verified(docs, sets, tested), "links")
    labels = saved(components(links), "labels")
    rest = saved(_open_pairs(postings, members, labels, tested), "open-pairs")
    if rest.limit(1).count():
        links = links.union(saved(_verified(docs, sets, rest), "more-links"))
        labels = saved(components(links), "labels")
    return rows, sets, labels


def _named(rows: DataFrame, sets: DataFrame, labels: DataFrame) -> DataFrame:
    named = sets.join(labels, F.col("member") == F.col("node"), "left").select(
        "member", F.coalesce("component", "member").alias("label"), "doc_id"
    )
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "label").select(F.col("member").alias("of"), "component_id")
    joined = rows.join(named, (F.col("member") == F.col("of")) & (F.col("size") > 0), "left")
    component = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id"))
