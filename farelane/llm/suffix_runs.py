"""Sorted, front-coded runs of anchored suffixes, and their merge by a loser tree.

Every string of SPAN bytes has one anchor: the leftmost of its GRAM-byte strings with the
smallest hash. Equal strings have equal anchors at equal places, so it is enough to sort the
suffixes that start at anchors. An entry stands for neighbouring strings that share an anchor:
the suffix from the anchor (right), the bytes before it (left, nearest first), and the
documents in which it occurs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import zstandard
from numpy.lib.stride_tricks import sliding_window_view

#: Places whose hashes are found at a time, entries of a run that are objects at a time, and entries merged at a time, about.
STEP, FEED, BLOCK = 1 << 18, 256, 1 << 15
SPAN = 50
GRAM = 20
#: Places an anchor can have in a string of SPAN bytes; at most so many bytes less one lie before it.
PLACES = SPAN - GRAM + 1
LEFT = PLACES - 1
LOW = np.uint64(0xFFFFFFFF)
NO_PLACE = np.uint8(255)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _gram_hashes(data: np.ndarray, places: slice | np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes at each of the places; ``data`` is longer than these by 3 * SPAN."""
    words = [np.ndarray(len(data) - at - 7, "<u8", data.data, at, (1,))[places] for at in (0, 8, GRAM - 8)]
    hashes = words[0] * np.uint64(0xD6E8FEB86659FD93)
    hashes ^= words[1]
    hashes *= np.uint64(0xA0761D6478BD642F)
    hashes ^= hashes >> np.uint64(32)
    hashes += words[2]
    return mixed(hashes)


def _anchors(hashes: np.ndarray) -> np.ndarray:
    """The anchor of the string that starts at each place."""
    smallest = (hashes & ~LOW) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while 2 * width <= PLACES:
        smallest = np.minimum(smallest[:-width], smallest[width:])
        width *= 2
    if width < PLACES:
        rest = PLACES - width
        smallest = np.minimum(smallest[:-rest], smallest[rest:])
    return (smallest & LOW).astype(np.int64)


class AnchoredTexts:
    """Texts laid end to end, and the occurrences of entries in them.

    ``begin`` is where the first string of an occurrence starts, ``last`` where its last one
    does, ``anchor`` where their anchor lies. Texts that do not ``count`` have none.
    """

    def __init__(self, texts: list[bytes], counts: np.ndarray):
        sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.total = int(self.ends[-1]) if len(texts) else 0
        self.laid = np.frombuffer(b"".join([bytes(LEFT), *texts, bytes(3 * SPAN)]), np.uint8)
        data = self.laid[LEFT:]
        # How far behind each place its anchor lies.
        behind = np.empty(self.total, np.uint8)
        for a in range(0, self.total, STEP):
            n = min(STEP, self.total - a)
            behind[a : a + n] = _anchors(_gram_hashes(data, slice(a, a + n + PLACES)))[:n] - np.arange(n)
        # A string of SPAN bytes that starts here ends within its text.
        fits = np.where(counts, np.maximum(sizes - SPAN + 1, 0), 0)
        edges = np.zeros(self.total + 1, np.int8)
        edges[self.starts[fits > 0]] = 1
        edges[(self.starts + fits)[fits > 0]] = -1
        valid = np.cumsum(edges[:-1], dtype=np.int8) > 0
        changes = np.ones(self.total + 1, bool)
        changes[1:-1] = (behind[1:] + np.uint8(1) != behind[:-1]) | ~valid[1:] | ~valid[:-1]
        changes[self.starts[fits > 0]] = True
        self.begin = np.flatnonzero(changes[:-1] & valid)
        self.last = np.flatnonzero(changes[1:] & valid)
        self.anchor = self.begin + behind[self.begin]
        self.doc = np.searchsorted(self.ends, self.begin, side="right")
        self.hash = mixed(_gram_hashes(data, self.anchor) ^ np.uint64(0x5851F42D4C957F2D))

    def fingerprints(self, slices: int) -> tuple[np.ndarray, np.ndarray]:
        """Slice and 32-bit fingerprint of each occurrence, by its anchor's bytes."""
        return ((self.hash >> np.uint64(32)) % np.uint64(slices)).astype(np.int64), (self.hash & LOW).astype(np.uint32)


def pack_numbers(values: np.ndarray) -> bytes:
    """Integers by planes of bytes, compressed; ascending ones are best given as differences."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes() if len(values) else b""
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack_numbers(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).ravel()


def _common(rows: np.ndarray, width: int) -> np.ndarray:
    """Bytes that each row shares with the row before it."""
    found = np.zeros(len(rows), np.uint8)
    if len(rows) > 1:
        equal = rows[1:, :width] == rows[:-1, :width]
        found[1:] = np.where(equal.all(axis=1), width, equal.argmin(axis=1))
    return found


class Entries:
    """Sorted distinct entries: right and left as padded rows, their lengths, smallest document."""

    def __init__(self, right: np.ndarray, right_size: np.ndarray, left: np.ndarray, left_size: np.ndarray, common: np.ndarray, smallest: np.ndarray):
        self.right, self.right_size, self.left, self.left_size = right, right_size, left, left_size
        self.common, self.smallest = common, smallest

    @classmethod
    def of(cls, texts: AnchoredTexts, chosen: np.ndarray, ids: np.ndarray) -> tuple[Entries, np.ndarray]:
        """The entries of chosen occurrences, and the entry of each of these."""
        begin, anchor = texts.begin[chosen], texts.anchor[chosen]
        before, size = anchor - begin, texts.last[chosen] + SPAN - anchor
        rows = np.zeros((len(chosen), SPAN + LEFT + 2), np.uint8)
        rows[:, :SPAN] = sliding_window_view(texts.laid[LEFT:], SPAN)[anchor]
        rows[:, :SPAN][np.arange(SPAN) >= size[:, None]] = 0
        rows[:, SPAN] = size
        rows[:, SPAN + 1 : -1] = sliding_window_view(texts.laid, LEFT)[anchor][:, ::-1]
        rows[:, SPAN + 1 : -1][np.arange(LEFT) >= before[:, None]] = 0
        rows[:, -1] = before
        order = np.argsort(rows.view(f"S{rows.shape[1]}").ravel(), kind="stable")
        rows = rows[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
        entry = np.empty(len(rows), np.int64)
        entry[order] = np.cumsum(new) - 1
        heads = np.flatnonzero(new)
        own = ids[texts.doc[chosen]][order]
        smallest = np.minimum.reduceat(own, heads) if len(heads) else own
        rows = rows[new]
        return cls(rows[:, :SPAN], rows[:, SPAN], rows[:, SPAN + 1 : -1], rows[:, -1], _common(rows, SPAN), smallest), entry

    def to_bytes(self) -> bytes:
        """Front coding: of each right only the bytes after those shared with the one before it."""
        own = (np.arange(SPAN) >= self.common[:, None]) & (np.arange(SPAN) < self.right_size[:, None])
        near = np.arange(LEFT) < self.left_size[:, None]
        parts = [
            pack_numbers(np.stack([self.common, self.right_size, self.left_size], axis=1)),
            zstandard.ZstdCompressor(level=3).compress(self.right[own].tobytes()),
            zstandard.ZstdCompressor(level=3).compress(self.left[near].tobytes()),
            pack_numbers(self.smallest.astype("<i8")),
        ]
        return b"".join(len(p).to_bytes(4, "little") + p for p in parts)

    @classmethod
    def from_bytes(cls, blob: bytes) -> Entries:
        parts, at = [], 0
        while at < len(blob):
            size = int.from_bytes(blob[at : at + 4], "little")
            parts.append(blob[at + 4 : at + 4 + size])
            at += 4 + size
        common, right_size, left_size = np.ascontiguousarray(unpack_numbers(parts[0], "V3").view(np.uint8).reshape(-1, 3).T)
        n = len(common)
        right, left = np.zeros((n, SPAN), np.uint8), np.zeros((n, LEFT), np.uint8)
        own = (np.arange(SPAN) >= common[:, None]) & (np.arange(SPAN) < right_size[:, None])
        right[own] = np.frombuffer(zstandard.ZstdDecompressor().decompress(parts[1]), np.uint8)
        for i in range(SPAN):  # a shared byte is that of the nearest row before that has its own
            source = np.maximum.accumulate(np.where(common <= i, np.arange(n), 0))
            right[:, i] = right[source, i]
        left[np.arange(LEFT) < left_size[:, None]] = np.frombuffer(zstandard.ZstdDecompressor().decompress(parts[2]), np.uint8)
        return cls(right, right_size, left, left_size, common, unpack_numbers(parts[3], "<i8"))


def _feed(run: Entries) -> Iterator[tuple[int, bytes]]:
    """The bytes each entry shares with the one before, and its right, a few as objects at a time."""
    for a in range(0, len(run.right), FEED):
        raw = run.right[a : a + FEED].tobytes()
        yield from zip(run.common[a : a + FEED].tolist(), (raw[i : i + SPAN] for i in range(0, len(raw), SPAN)))


def merged_blocks(runs: list[Entries], block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Merged order of the entries of all runs, laid end to end, and the bytes each shares with the one before.

    A loser tree over the runs. Every loser knows the bytes it shares with the winner that beat
    it, so two candidates are compared from the first byte on that is not known to be equal.
    A block ends after ``block`` entries, as soon as the next one has other anchor bytes.
    """
    number = np.cumsum([0] + [len(r.right) for r in runs]).tolist()  # of the entry each run stands at
    feeds = [_feed(r) for r in runs]
    end = (-1, b"")
    first, word = [list(x) for x in zip(*(next(f, end) for f in feeds))] if runs else ([], [])
    leaves = 1
    while leaves < len(runs):
        leaves *= 2
    loser, shared = [-1] * leaves, [-1] * leaves

    def play(node: int) -> tuple[int, int]:
        """The first winner below a node, filling in losers on the way; runs at their end lose."""
        if node >= leaves:
            run = node - leaves
            return (run, first[run]) if run < len(runs) else (run, -1)
        one, one_shared = play(2 * node)
        other, other_shared = play(2 * node + 1)
        if other_shared < 0 or one_shared < 0:
            if one_shared < 0:
                one, one_shared, other, other_shared = other, other_shared, one, one_shared
            loser[node], shared[node] = other, other_shared
            return one, one_shared
        a, b, i = word[one], word[other], 0
        while i < SPAN and a[i] == b[i]:
            i += 1
        if i < SPAN and b[i] < a[i]:
            one, other = other, one
        loser[node], shared[node] = other, i
        return one, 0

    out, out_shared = [], []
    run, common = play(1) if leaves > 1 else (0, first[0] if first else -1)
    while common >= 0:
        if common < GRAM and len(out) >= block:
            yield np.array(out, np.int64), np.array(out_shared, np.int64)
            out, out_shared = [], []
        out.append(number[run])
        out_shared.append(common)
        number[run] += 1
        common, word[run] = next(feeds[run], end)
        node = (run + leaves) >> 1
        while node:
            known = shared[node]
            if known > common:
                loser[node], run, shared[node], common = run, loser[node], common, known
            elif known == common >= 0:
                other = loser[node]
                a, b = word[run], word[other]
                if a == b:
                    shared[node] = SPAN
                else:
                    i = known
                    while a[i] == b[i]:
                        i += 1
                    shared[node] = i
                    if b[i] < a[i]:
                        loser[node], run = run, other
            node >>= 1
    if out:
        yield np.array(out, np.int64), np.array(out_shared, np.int64)


def merge_runs(runs: list[Entries]) -> tuple[np.ndarray, np.ndarray]:
    """The blocks of ``merged_blocks`` as one."""
    order, shared = zip(*merged_blocks(runs), (np.zeros(0, np.int64),) * 2)
    return np.concatenate(order), np.concatenate(shared)


def smallest_by_place(runs: list[Entries], block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Entries (all runs end to end) with a smaller document, the first of the places, how many more follow, and that document.

    At place o of the anchor the string of an entry is its o nearest left bytes and its first SPAN - o
    right ones. Entries that share these right bytes are neighbours in merged order and in one block;
    their left bytes are compared by a 64-bit hash.
    """
    if not runs:
        return
    every, cuts = [], np.cumsum([len(r.right) for r in runs])[:-1]
    for name in ("right_size", "left_size", "left", "smallest"):
        every.append(np.concatenate([getattr(r, name) for r in runs]))
        for r, part in zip(runs, np.split(every[-1], cuts)):  # runs keep views, so nothing is held twice
            setattr(r, name, part)
    for order, shared in merged_blocks(runs, block):
        right_size, left_size, left, own = (x[order] for x in every)
        left_hash = np.zeros(len(order), np.uint64)
        # The range of places that each entry is in, and its document; NO_PLACE ends what has not begun.
        begun, ended, known = np.zeros(len(order), np.uint8), np.full(len(order), NO_PLACE), np.zeros(len(order), np.int64)
        for place in range(PLACES):
            if place:
                left_hash = left_hash * np.uint64(0x2545F4914F6CDD1D) + left[:, place - 1] + np.uint64(1)
            group = np.cumsum(shared < SPAN - place)
            here = np.flatnonzero((right_size >= SPAN - place) & (place <= left_size))
            here = here[np.bincount(group[here], minlength=int(group[-1]) + 1)[group[here]] > 1]
            if not len(here):
                continue
            key = mixed(left_hash[here] ^ mixed(group[here].astype(np.uint64)))
            by_key = np.argsort(key, kind="stable")
            here, key = here[by_key], key[by_key]
            heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            least = np.repeat(np.minimum.reduceat(own[here], heads), np.diff(np.r_[heads, len(here)]))
            smaller = least < own[here]
            here, least = here[smaller], least[smaller]
            fresh = (ended[here] != place) | (known[here] != least)
            over = here[fresh & (ended[here] != NO_PLACE)]
            yield order[over], begun[over], ended[over] - begun[over] - np.uint8(1), known[over]
            begun[here[fresh]] = place
            ended[here], known[here] = place + 1, least
        over = np.flatnonzero(ended != NO_PLACE)
        yield order[over], begun[over], ended[over] - begun[over] - np.uint8(1), known[over]
