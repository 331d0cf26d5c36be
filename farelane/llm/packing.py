"""Packing of token streams into sequences by order-preserving dynamic programming.

Documents keep their order. Sequences end at ends of documents or sentences, and in
sentences too long for that at steps inside them. The cuts minimise padding plus
penalties for cutting a document; as padding is linear in the place of a cut, the best
earlier cut of a window comes off a monotone queue.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from farelane.llm.chunk_encoder import WORDS, chunk_encoder
from farelane.llm.common import in_slices, mapped, texts

WINDOW = 4096
#: Costs in padded tokens: cutting a document at a sentence, inside one, and any sequence.
SENTENCE_CUT, INNER_CUT, SEQUENCE = 6, 48, 2
#: A sentence longer than this many ids may be cut at steps of this many.
INNER_STEP = 192
#: Ids packed together; a run ends with a document.
RUN_IDS = 1 << 20
SENTENCE_ENDS = (".", "!", "?", "。", "！", "？", "…", ";", "|")

PIECES_DDL = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded long"
)


def padded_length(length: int, window: int = WINDOW) -> int:
    """A sequence is padded to the window unless its length is a power of two."""
    return length if length & (length - 1) == 0 else window


def sentence_end_ids(vocab: dict[str, int], suffix: str) -> np.ndarray:
    """Ids of tokens that end a word with the punctuation of a sentence's end."""
    from farelane.llm.bpe import byte_letters

    letters = byte_letters()
    ends = tuple("".join(letters[b] for b in mark.encode()) + suffix for mark in SENTENCE_ENDS)
    return np.array(sorted(i for token, i in vocab.items() if token.endswith(ends)), np.uint32)


def cut_places(ids: np.ndarray, doc_ends: np.ndarray, sentence_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places after which a sequence may end, ascending, and the penalty of each."""
    kind = np.zeros(len(ids) + 1, np.int8)
    kind[np.flatnonzero(sentence_ends[ids]) + 1] = 2
    kind[doc_ends] = 3
    kind[0] = 0
    soft = np.r_[0, np.flatnonzero(kind)]
    for start in soft[:-1][np.diff(soft) > INNER_STEP]:
        end = soft[np.searchsorted(soft, start, "right")]
        kind[start + INNER_STEP : end : INNER_STEP] = 1
    places = np.flatnonzero(kind)
    penalty = np.array([0, INNER_CUT, SENTENCE_CUT, 0])[kind[places]]
    return places, penalty


def best_cuts(places: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> list[int]:
    """The chosen ends among ascending ``places``, the last always among them.

    No two neighbouring places, nor 0 and the first, may lie more than a window apart.
    """
    at = [0, *places.tolist()]
    fine = [0, *penalty.tolist()]
    spots = np.array(at)
    # Sequences of a power of two: pairs of places exactly so far apart, by the later one.
    later, earlier, size = [], [], 1
    while size < window:
        from_ = np.searchsorted(spots, spots - size)
        hits = np.flatnonzero((spots >= size) & (spots[from_] == spots - size))
        later.append(hits)
        earlier.append(from_[hits])
        size *= 2
    order = np.argsort(np.concatenate(later), kind="stable")
    origins = np.concatenate(earlier)[order].tolist()
    until = np.cumsum(np.bincount(np.concatenate(later), minlength=len(at))).tolist()
    hit = 0
    cost, back = [0] * len(at), [0] * len(at)
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (cost + place, index), ascending in both
    for j in range(1, len(at)):
        here = at[j]
        low = here - window
        while at[queue[0][1]] < low:
            queue.popleft()
        best, origin = queue[0]
        best += window - here
        while hit < until[j]:
            i = origins[hit]
            if cost[i] < best:
                best, origin = cost[i], i
            hit += 1
        cost[j] = best = best + fine[j] + SEQUENCE
        back[j] = origin
        key = best + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    cuts, j = [], len(at) - 1
    while j:
        cuts.append(at[j])
        j = back[j]
    return cuts[::-1]


def _pieces(keys: list, ids: list[np.ndarray], sentence_ends: np.ndarray, first_sequence: int) -> tuple[pa.RecordBatch, int]:
    flat = np.concatenate(ids)
    doc_ends = np.cumsum([len(i) for i in ids])
    cuts = np.array(best_cuts(*cut_places(flat, doc_ends, sentence_ends)))
    bounds = np.union1d(doc_ends, cuts)
    starts = np.r_[0, bounds[:-1]]
    doc = np.searchsorted(doc_ends, starts, "right")
    sequence = np.searchsorted(cuts, starts, "right")
    sequence_starts, doc_starts = np.r_[0, cuts[:-1]], np.r_[0, doc_ends[:-1]]
    lengths = np.diff(np.r_[0, cuts])
    padded = np.where(lengths & (lengths - 1) == 0, lengths, WINDOW)
    little = flat.astype("<u4", copy=False)
    columns = [
        pa.array([keys[d] for d in doc.tolist()], pa.int64()),
        pa.array(starts - doc_starts[doc]),
        pa.array(bounds - starts),
        pa.array([zlib.crc32(little[a:b].tobytes()) for a, b in zip(starts, bounds)], pa.int64()),
        pa.array((doc_ends - doc_starts)[doc]),
        pa.array(first_sequence + sequence),
        pa.array(starts - sequence_starts[sequence]),
        pa.array(padded[sequence]),
    ]
    names = [part.split()[0] for part in PIECES_DDL.split(", ")]
    return pa.RecordBatch.from_arrays([c.cast(pa.int64()) for c in columns], names=names), len(cuts)


def pack_documents(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded.

    Every task packs the documents it reads, in their order, so no text is moved and no
    sequence spans two tasks. A document is its ids and ``end_id``; null and empty texts
    are the end id alone. ``padded`` is the stored length of the piece's sequence. Rows of
    one or no doc_id are documents of their own. Other columns are left out; an empty
    table gives no piece.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(path, WORDS)
        tokenizer = encoder.tokenizer
        ends = np.zeros(tokenizer.get_vocab_size() + 1, bool)
        ends[sentence_end_ids(tokenizer.get_vocab(), tokenizer.model.end_of_word_suffix or "")] = True
        end = np.array([end_id], np.uint32)
        keys: list = []
        ids: list[np.ndarray] = []
        held, sequence = 0, TaskContext.get().partitionId() << 36
        for batch in in_slices(batches, 128):
            for key, found in zip(batch.column(0).to_pylist(), encoder.encode(texts(batch.column(1)))):
                keys.append(key)
                ids.append(np.concatenate([found, end]))
                held += len(found) + 1
                if held >= RUN_IDS:
                    pieces, used = _pieces(keys, ids, ends, sequence)
                    yield pieces
                    keys, ids, held, sequence = [], [], 0, sequence + used
        if keys:
            yield _pieces(keys, ids, ends, sequence)[0]

    return mapped(docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text"), run, PIECES_DDL)
