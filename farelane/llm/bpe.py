"""Encoding and decoding with a byte pair vocabulary, cut at forced boundaries.

Two neighbouring bytes that no vocabulary token holds side by side can never be merged
over, so a word is cut there with certainty. The fragments are merged independently, each
distinct one once, and their tokens concatenated. The library prepares words and merges
the symbols of a fragment; cutting, joining, decoding and special tokens are done here.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from farelane.llm.chunk_encoder import WORDS
from farelane.llm.common import in_slices, mapped, texts

#: Words kept per generation of the cache; two generations live at a time.
CACHED_WORDS = 200_000
#: Texts with more characters in new words than this are encoded one by one and not cached.
BATCH_CHARS = 4_000_000

Encoded = tuple[int, str, str]


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(extra)
            extra += 1
    return [letters[b] for b in range(256)]


class ForcedBoundaryBpe:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in {**self.vocab, **self.special}.items()}
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"])
        tokenizer = Tokenizer.from_file(path)
        self.normalizer, self.splitter = tokenizer.normalizer, tokenizer.pre_tokenizer
        self.inner, self.last = BPE(self.vocab, list(pairs)), tokenizer.model
        self.letters = byte_letters()
        self.joined = self._joined_pairs()
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.young: dict[str, Encoded] = {}
        self.old: dict[str, Encoded] = {}

    def _joined_pairs(self) -> set[str]:
        """Every pair of neighbouring letters, one per byte, inside some token."""
        found = set()
        for token in self.vocab:
            body = token[: -len(self.suffix)] if self.suffix and token.endswith(self.suffix) else token
            found.update(body[i : i + 2] for i in range(len(body) - 1))
        return found

    def fragments(self, word: str) -> list[str]:
        """A word, one letter per byte, cut wherever no token spans the neighbours."""
        cuts = [0, *(i for i in range(1, len(word)) if word[i - 1 : i + 1] not in self.joined), len(word)]
        return [word[a:b] for a, b in zip(cuts, cuts[1:])]

    def _words(self, chunks: list[str]) -> list[list[str]]:
        """The words of every chunk as the library prepares them, from one call for all."""
        normal = [self.normalizer.normalize_str(chunk) if not chunk.isascii() else chunk.lower() for chunk in chunks]
        ends = np.cumsum([len(n) + 1 for n in normal])
        found: list[list[str]] = [[] for _ in chunks]
        words = self.splitter.pre_tokenize_str("\n".join(normal))
        places = np.searchsorted(ends, np.fromiter((a for _, (a, _) in words), np.int64, len(words)), "right")
        for place, (word, _) in zip(places.tolist(), words):
            found[place].append(word)
        return found

    def word_tokens(self, word: str) -> list[str]:
        *parts, last = self.fragments(word)
        found = [token.value for part in parts for token in self.inner.tokenize(part)]
        return found + [token.value for token in self.last.tokenize(last)]

    def _encode_chunks(self, chunks: list[str]) -> Iterator[Encoded]:
        known: dict[str, list[str]] = {}
        for words in self._words(chunks):
            tokens = []
            for word in words:
                if word not in known:
                    known[word] = self.word_tokens(word)
                tokens += known[word]
            yield len(tokens), " ".join([str(self.vocab[t]) for t in tokens]), " ".join(tokens)

    def _learn(self, chunks: set[str]) -> None:
        new = []
        for chunk in chunks:
            if (known := self.old.get(chunk)) is not None:
                self.young[chunk] = known
            else:
                new.append(chunk)
        self.young.update(zip(new, self._encode_chunks(new)))

    def _split(self, text: str) -> list[str]:
        """Words between white space, and special tokens on their own."""
        if "<|" not in text:
            return WORDS.findall(text)
        pieces = self.split_special.split(text)
        return [c for i, piece in enumerate(pieces) for c in ([piece] if i % 2 else WORDS.findall(piece))]

    def encode_batch(self, texts: list[str]) -> Iterator[Encoded]:
        """Number of ids, ids joined by a space, and the decoded text of every text."""
        split = [self._split(text) for text in texts]
        chunks = set().union(*split)
        if len(self.young) + len(chunks) > CACHED_WORDS:
            self.old, self.young = self.young, {}
        missing = chunks.difference(self.young, self.special)
        if len(texts) > 1 and sum(map(len, missing)) > BATCH_CHARS:
            for text in texts:
                yield from self.encode_batch([text])
            return
        self._learn(missing)
        self.young.update((t, (1, str(i), t)) for t, i in self.special.items())
        for words in split:
            parts = [self.young[word] for word in words]
            counts, ids, decoded = zip(*parts) if parts else ((), (), ())
            yield sum(counts), " ".join(ids), " ".join(decoded)
        if sum(map(len, missing)) > BATCH_CHARS:
            self.young, self.old = {}, {}

    def encode(self, text: str) -> Encoded:
        return next(self.encode_batch([text]))


_MODELS: dict[str, ForcedBoundaryBpe] = {}


def bpe_model(path: str) -> ForcedBoundaryBpe:
    """One model per worker process, kept over tasks."""
    if path not in _MODELS:
        _MODELS[path] = ForcedBoundaryBpe(path)
    return _MODELS[path]


def decode(path: str, ids: list[int]) -> str:
    """The text of ids: a vocabulary of word ends without a decoder joins tokens by a space."""
    tokens = bpe_model(path).tokens
    return " ".join(tokens[i] for i in ids)


def encode_documents(docs: DataFrame, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids, decoded and the SHA-256 digests of both for every row of ``docs``.

    Special tokens written out in a text count as such, as in the library. A null or
    empty text has no ids and decodes to the empty text. Rows stay as they are:
    repeated rows give repeated results, a null doc_id stays null, other columns are
    left out, and an empty table gives an empty one. ``with_ids=False`` leaves ids and
    decoded out where only the digests are wanted.
    """
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64())]
    fields += [("ids", pa.list_(pa.int32())), ("decoded", pa.string())] if with_ids else []
    schema = pa.schema([*fields, ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    ddl = "doc_id long, n_tokens long, " + "ids array<int>, decoded string, " * with_ids
    ddl += "ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe_model(path)
        for batch in in_slices(batches, 128):
            columns: dict[str, list] = {field.name: [] for field in schema}
            for n, ids, decoded in model.encode_batch(texts(batch.column(1))):
                columns["n_tokens"].append(n)
                columns["ids_sha256"].append(hashlib.sha256(ids.encode()).hexdigest())
                columns["decoded_sha256"].append(hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest())
                if with_ids:
                    columns["ids"].append(np.array(ids.split(), np.int32))
                    columns["decoded"].append(decoded)
            columns["doc_id"] = batch.column(0)
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, schema.field(n).type) for n, c in columns.items()],
                schema=schema,
            )

    return mapped(docs.select(docs["doc_id"].cast("long"), "text"), run, ddl)
