"""Token counts against taking the longest token by trial, one after the other."""

from __future__ import annotations

import random
import re
import time

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tallyworks.llm.token_counts import LongestMatch, count_tokens, read_vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.json")
VOCABULARY = set(read_vocabulary(PATH))
BYTES = [bytes([byte]) for byte in range(256)]


def brute_force(data: bytes, vocabulary: set[bytes], longest: int) -> int:
    count = at = 0
    while at < len(data):
        at += next(n for n in range(longest, 0, -1) if data[at:at + n] in vocabulary
                   and at + n <= len(data))
        count += 1
    return count


def counted(text: str | None) -> int:
    words = [word for word in re.split("[ \t\n\x0b\x0c\r]+", text or "") if word]
    return sum(brute_force(b" " + word.encode(), VOCABULARY, 128) for word in words)


@pytest.fixture(scope="module")
def automaton():
    return LongestMatch(VOCABULARY)


@settings(max_examples=400, deadline=None)
@given(tokens=st.sets(st.text("abc", min_size=1, max_size=7)), text=st.text("abcd", max_size=60))
def test_any_vocabulary(tokens, text):
    vocabulary = {*BYTES, *(token.encode() for token in tokens)}
    assert LongestMatch(vocabulary).count(text.encode()) == brute_force(
        text.encode(), vocabulary, 7)


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=80))
def test_any_text(automaton, text):
    assert automaton.count_text(text) == counted(text)


def test_popped_counts():
    automaton = LongestMatch([*BYTES, b"ab", b"abcde", b"cd"])
    assert [automaton.count(x) for x in (b"", b"ab", b"abc", b"abcd", b"abcde", b"abcdf")] == [
        0, 1, 2, 2, 1, 3]
    with pytest.raises(ValueError):
        LongestMatch([b"a"])


def test_time_is_linear():
    """Tokens that nearly fit at every place: trial would take their length at each."""
    automaton = LongestMatch([*BYTES, b"a" * 3000 + b"b"])
    began = time.process_time()
    assert automaton.count(b"a" * 1_000_000) == 1_000_000
    assert time.process_time() - began < 10


def test_documents(spark, documents):
    found = {r.doc_id: r.n_tokens for r in count_tokens(documents, PATH).collect()}
    rows = random.Random(1).sample(documents.collect(), 60)
    assert len(found) == documents.count()
    assert [found[r.doc_id] for r in rows] == [counted(r.text) for r in rows]


def test_odd_rows(spark, odd_documents, no_documents):
    found = [tuple(r) for r in count_tokens(odd_documents, PATH).collect()]
    want = [(r.doc_id, counted(r.text)) for r in odd_documents.collect()]
    assert sorted(map(str, found)) == sorted(map(str, want))
    assert count_tokens(no_documents, PATH).count() == 0
