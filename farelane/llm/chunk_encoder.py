"""Ids of whole texts by the tokenizers library, each distinct chunk encoded once.

Both vocabularies used here never join characters over the start of a run of white
space and its word, so a text's ids are those of its chunks, one after another. Chunks
repeat far more often than texts; a bounded cache keeps their ids in flat arrays.
"""

from __future__ import annotations

import json
import re

import numpy as np

from farelane.llm.common import flat_ranges, remembered_for

#: The characters that Unicode calls white space.
WHITE = "\t-\r \x85\xa0  -     　"
#: A run of letters before a plain character that is none; both vocabularies' patterns part them there.
_STEM = r"[A-Za-zÀ-ÖØ-öø-ÿ]++(?=[\x00-@\[-`{-\x7f]|\Z)"
#: Words, for vocabularies that drop white space.
WORDS = re.compile(f"{_STEM}|[^{WHITE}]+")
#: Words with one space before them, and the white space left between such words.
SPACED = re.compile(f" ?{_STEM}| ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
CACHED_CHUNKS, CACHED_IDS = 500_000, 5_000_000
#: Characters below this one never change when they are composed; lower case changes them one by one.
COMPOSED = "\u0300"
#: Ends the words of vocabularies that mark them; no letter.
END_MARK = "\x01"
JOINED_CHUNKS = 4096


def _byte_letters() -> dict[str, int]:
    """The printable characters that byte-level vocabularies write for bytes."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


class RankedMerges:
    """Ids of words by the merges of a vocabulary, many words in one call.

    Wherever the merges of a vocabulary stand in the order of its ids and every token is merged
    from its own bytes, ranks of byte strings alone decide the merges. Words of a vocabulary with
    word ends get an end mark, which merges with their last byte before all else.
    """

    def __init__(self, ranks: dict[bytes, int], ids: np.ndarray, mark: str, lower: bool):
        from tiktoken import Encoding

        self.encoding = Encoding("merges", pat_str=r"[^\n]+|\n", mergeable_ranks=ranks, special_tokens={})
        self.ids, self.mark, self.lower, self.line = ids, mark, lower, ranks[b"\n"]

    @classmethod
    def of(cls, path: str) -> RankedMerges | None:
        """None for a vocabulary of another kind."""
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model, letters = told["model"], _byte_letters()
        vocabulary, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        normal = json.dumps(told["normalizer"] or {})
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        merged = [vocabulary.get(a + b) for a, b in pairs]
        if model["type"] != "BPE" or None in merged or sorted(merged) != merged or "Prepend" in normal or "Strip" in normal:
            return None
        single = [c for c in letters if c in vocabulary]
        ended = [c + suffix for c in letters if c + suffix in vocabulary] if suffix else []
        if len(single) < 256 or (suffix and len(ended) < 256):
            return None

        def raw(token: str) -> bytes:
            end = bool(suffix) and token.endswith(suffix)
            return bytes(letters[c] for c in (token.removesuffix(suffix) if end else token)) + (END_MARK.encode() if end else b"")

        order = [*single, *ended, *(a + b for a, b in pairs)]
        ranks: dict[bytes, int] = {}
        ids = []
        for token in order:
            if raw(token) not in ranks:
                ranks[raw(token)] = len(ids)
                ids.append(vocabulary[token])
        return cls(ranks, np.array(ids, np.uint32), END_MARK if suffix else "", "Lowercase" in normal)

    def takes(self, chunk: str) -> bool:
        """Whether a chunk is one word of letters that normalising keeps one word."""
        word = chunk[1:] if chunk[0] == " " and not self.mark else chunk
        if not word.isalpha():
            return False
        return not self.lower or word.isascii() or (max(word) < COMPOSED and word.lower().isalpha())

    def encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks, one after another, and the number of each."""
        text = f"{self.mark}\n".join(chunks) + self.mark
        found = self.encoding.encode_to_numpy(text.lower() if self.lower else text)
        ends = np.flatnonzero(found == self.line)
        counts = np.diff(np.r_[-1, ends, len(found)]) - 1
        return self.ids[found[found != self.line]], counts


class _Places(dict):
    """Numbers chunks in the order of their first use and remembers the new ones."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        place = self[chunk] = len(self)
        self.new.append(chunk)
        return place


class ChunkEncoder:
    def __init__(self, path: str, chunks: re.Pattern):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.chunks = chunks
        special = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.merges = RankedMerges.of(path)
        self._forget()

    def _forget(self) -> None:
        self.place = _Places()
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.lengths = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _learn(self, chunks: list[str]) -> None:
        """Encodes new chunks and numbers them: those of letters alone by their merges, others by the library."""
        takes = self.merges.takes if self.merges else lambda chunk: False
        plain = [i for i, c in enumerate(chunks) if takes(c)]
        odd = sorted(set(range(len(chunks))).difference(plain))
        first = len(self.place) - len(chunks)
        lengths, parts = np.zeros(len(chunks), np.int64), []
        for start in range(0, len(plain), JOINED_CHUNKS):
            part = plain[start : start + JOINED_CHUNKS]
            ids, lengths[part] = self.merges.encode([chunks[i] for i in part])
            parts.append(ids)
        for i in odd:
            parts.append(np.array(self.tokenizer.encode(chunks[i], add_special_tokens=False).ids, np.uint32))
            lengths[i] = len(parts[-1])
        order = np.array(plain + odd, np.int64)
        self._keep(np.concatenate(parts), order, lengths[order], first)

    def _keep(self, ids: np.ndarray, order: np.ndarray, lengths: np.ndarray, first: int) -> None:
        """Ids of chunks ``order``, numbered from ``first`` on, of these lengths."""
        total, count = len(ids), len(lengths)
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while first + count > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        self.ids[self.used : self.used + total] = ids
        self.starts[first + order] = self.used + np.cumsum(lengths) - lengths
        self.lengths[first + order] = lengths
        self.used += total

    def _places(self, chunks: list[str]) -> np.ndarray:
        if len(self.place) > CACHED_CHUNKS:
            self._forget()
        places = np.fromiter(map(self.place.__getitem__, chunks), np.int64, len(chunks))
        new, self.place.new = self.place.new, []
        if new:
            self._learn(new)
        return places

    def split(self, text: str) -> list[str]:
        if self.special is None or "<|" not in text:
            return self.chunks.findall(text)
        pieces = self.special.split(text)
        return [c for i, piece in enumerate(pieces) for c in ([piece] if i % 2 else self.chunks.findall(piece))]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text as unsigned 32-bit integers."""
        split = [self.split(text) for text in texts]
        counts = np.cumsum([0] + [len(chunks) for chunks in split])
        places = self._places([chunk for chunks in split for chunk in chunks])
        lengths = self.lengths[places]
        ids = self.ids[flat_ranges(self.starts[places], lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])[counts]
        found = [ids[a:b] for a, b in zip(ends, ends[1:])]
        if self.used > CACHED_IDS:
            self._forget()
        return found


_ENCODERS: dict[tuple, ChunkEncoder] = {}
remembered_for(("farelane.llm.packing", "farelane.llm.token_files"), _ENCODERS.clear)


def chunk_encoder(path: str, chunks: re.Pattern) -> ChunkEncoder:
    """One encoder per worker process, kept over tasks."""
    key = (path, chunks.pattern)
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(path, chunks)
    return _ENCODERS[key]
