"""Unbroken runs of letters and symbols: the library's ids, in time that allows a megabyte."""

from __future__ import annotations

import random
import time

import public_tokenizers
import pytest
import tokenizers
from tallyworks.llm.bpe import LONG, Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = tokenizers.Tokenizer.from_file(PATH)
SIZES = [LONG - 1, LONG, LONG + 1, 777, 1_000_000]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer(PATH)


@pytest.mark.parametrize("letters", ["x", "ab", "etaoinshrdlu", "-=", "\u00e9\u00df\u65e5a"])
@pytest.mark.parametrize("size", SIZES)
def test_long_runs(tokenizer, letters, size):
    draw = random.Random(size)
    run = "".join(draw.choices(letters, k=size))
    began = time.process_time()
    ids = tokenizer.merge(run)
    assert time.process_time() - began < 60
    assert ids == LIBRARY.encode(run, add_special_tokens=False).ids
