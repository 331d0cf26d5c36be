"""Words by ranked merges against the tokenizers library."""

import json
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from farelane.llm.chunk_encoder import END_MARK, RankedMerges
from farelane.llm.common import tokenizer_file

FILES = [tokenizer_file("word_bpe_49k.json"), tokenizer_file("byte_bpe_50k.json")]


def same_as_library(path, words):
    merges, library = RankedMerges.of(path), Tokenizer.from_file(path)
    words = [w for w in dict.fromkeys(words) if merges.takes(w)]
    ids, counts = merges.encode(words)
    ends = np.cumsum(counts)
    wrong = [w for w, a, b in zip(words, ends - counts, ends) if ids[a:b].tolist() != library.encode(w, add_special_tokens=False).ids]
    assert not wrong
    return len(words)


@pytest.mark.parametrize("path", FILES)
def test_every_token_that_is_a_word(path):
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    words = [t.removesuffix("</w>").replace("Ġ", " ") for t in vocabulary]
    assert same_as_library(path, [w for w in words if w.strip(" ")]) > 20_000


@pytest.mark.parametrize("path", FILES)
def test_invented_words(path):
    rng = random.Random(3)
    letters = "etaoinshrdlucmfwypvbgkjqxz" * 3 + "ETAOIN" + "äöüßéèñçœøåÀÉÑĞıIİſªºǅ" + "漢字Σσςя"
    words = [rng.choice(["", " "]) + "".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 5, 9, 20]))) for _ in range(20_000)]
    assert same_as_library(path, words + ["a" * 5000, " " + "z" * 3000]) > 4000


def test_words_left_to_the_library():
    word, byte = map(RankedMerges.of, FILES)
    for chunk in ("it's", "a1", "İ", "Σας", "漢", " the", "<|endoftext|>", END_MARK, "a" + END_MARK):
        assert not word.takes(chunk)
    assert word.takes("é") and word.takes("Straße") and byte.takes(" the") and byte.takes("漢") and not byte.takes("  the")


def test_other_vocabularies_are_refused(tmp_path):
    with open(FILES[1], encoding="utf-8") as file:
        told = json.load(file)
    told["model"]["merges"] = told["model"]["merges"][::-1]
    (tmp_path / "other.json").write_text(json.dumps(told))
    assert RankedMerges.of(str(tmp_path / "other.json")) is None
