"""Groups, links and counts against comparing all byte ranges."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tallyworks.llm.alignment import (
    Aligner, Side, align, align_documents, digest_alignments, packed, unpacked,
)
from tallyworks.llm.bpe import byte_symbols
from tokenizers import Tokenizer

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")


def ranges(lengths):
    ends = np.cumsum(lengths).tolist()
    return list(zip([0, *ends], ends))


def brute_force(a, b, bytes_a, bytes_b):
    """(groups, links) by every pair of byte ranges."""
    left, right = (ranges([len(of[i]) for i in ids]) for ids, of in ((a, bytes_a), (b, bytes_b)))
    links = [(a[i], b[j]) for i, x in enumerate(left) for j, y in enumerate(right)
             if x[0] < y[1] and y[0] < x[1]]
    groups, at = [], 0
    for end in sorted({y for _, y in left} & {y for _, y in right}):
        groups.append(tuple(",".join(str(i) for i, (s, e) in zip(ids, of) if at <= s and e <= end)
                            for ids, of in ((a, left), (b, right))))
        at = end
    return ";".join(f"{x}|{y}" for x, y in groups), sorted(links)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=14), st.randoms())
def test_any_cuts(lengths, draw):
    of = [b"", b"w", b"ww", b"www", b"wwww"]
    total, other = sum(lengths), []
    while total:
        other.append(draw.randint(1, min(4, total)))
        total -= other[-1]
    left, right = Side(of, "|"), Side(of, ";")
    aligned = align(lengths, other, left, right)
    assert (aligned.written(left, right), sorted(zip(aligned.link_a, aligned.link_b))) == brute_force(
        lengths, other, of, of)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1 << 40)))
def test_packed(numbers):
    assert unpacked(packed(np.array(numbers, np.int64))).tolist() == numbers


class Plain:
    """The same two files through their libraries, one document at a time."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        byte = {symbol: number for number, symbol in byte_symbols().items()}
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        self.bytes_a = {i: bytes(map(byte.__getitem__, token))
                        for token, i in self.a.get_vocab().items() if token not in special}
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.bytes_b = {i: bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i)
                        else self.b.id_to_piece(i).replace("▁", " ").encode()
                        for i in range(self.b.get_piece_size())}

    def __call__(self, text):
        if not text:
            return [], [], "", []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        whole = (" " + text).encode()
        if any(b"".join(of[i] for i in ids) != whole
               for ids, of in ((a, self.bytes_a), (b, self.bytes_b))):
            return [], [], "", []
        return a, b, *brute_force(a, b, self.bytes_a, self.bytes_b)


@pytest.fixture(scope="module")
def plain():
    return Plain()


TEXTS = ["Hello, world", " leading", "two  spaces\n\nlines\t", "▁ mark", "日本語と한국어 🙂",
         "<|endoftext|> <s> </s> <0x41>", "x" * 300, "ﬁ ﬀ é  ", "\x00\x01 zero", "1234567.89"]


@pytest.mark.parametrize("text", TEXTS)
def test_texts(plain, text):
    aligner = Aligner(A, B)
    aligned = aligner.align(text)
    a, b, groups, links = plain(text)
    assert (aligned.a.tolist(), aligned.b.tolist(), aligner.written(aligned)) == (a, b, groups)
    assert sorted(zip(aligned.link_a, aligned.link_b)) == links


def wanted(rows, plain):
    made = [(doc_id, *plain(text)) for doc_id, text in rows]
    docs = Counter(pair for *_, links in made for pair in set(links))
    highest = {}
    for (a, _), n in docs.items():
        highest[a] = max(highest.get(a, 0), n)
    return [(doc_id, len(a), len(b), groups.count(";") + 1 if groups else 0, len(links),
             hashlib.sha256(groups.encode()).hexdigest() if groups else "",
             sum(docs[link] == highest[link[0]] for link in links),
             sum(docs[link] for link in links)) for doc_id, a, b, groups, links in made]


def test_whole_query(spark, documents, plain):
    """Counts run over all documents, here over all that brute force can take."""
    docs = documents.filter("length(text) < 1500").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert len(rows) > 50
    for parts in (1, 7):
        found = digest_alignments(docs.repartition(parts), A, B)
        assert sorted(map(tuple, found.collect())) == sorted(wanted(rows, plain))


def test_blocks_do_not_change_counts(spark, documents):
    want = sorted(map(tuple, digest_alignments(documents, A, B).collect()))
    assert sorted(map(tuple, digest_alignments(documents, A, B, 1 << 14).collect())) == want
    assert len(want) == documents.count()


def test_odd_rows(spark, odd_documents, no_documents, plain):
    short = [(r.doc_id, r.text) for r in odd_documents.collect() if len(r.text or "") < 5000]
    docs = spark.createDataFrame(short * 2, "doc_id long, text string")
    found = sorted(map(str, map(tuple, digest_alignments(docs, A, B).collect())))
    assert found == sorted(map(str, wanted(short * 2, plain)))
    assert digest_alignments(odd_documents, A, B).count() == odd_documents.count()
    assert digest_alignments(no_documents, A, B).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, digest_alignments(nothing, A, B).collect())) == [
        (i, 0, 0, 0, 0, "", 0, 0) for i in (1, 2)]


def test_real_outputs(spark):
    docs = spark.createDataFrame([(1, "Hello"), (2, "Hello there")], "doc_id long, text string")
    rows = {r.doc_id: r for r in align_documents(docs, A, B).collect()}
    aligner = Aligner(A, B)
    hello, there = (aligner.written(aligner.align(text)) for text in ("Hello", "Hello there"))
    assert rows[1].groups == hello and rows[2].groups == there
    assert rows[1].count_sum == 2 * rows[1].n_links


def test_texts_together_are_as_alone(plain):
    """One alignment of many texts gives each what it has alone, also beside texts without tokens."""
    texts = ["▁ mark", None, *TEXTS, "", "ﬁ", *TEXTS[::-1], None]
    rows = list(Aligner(A, B).rows(texts))
    assert len(rows) == len(texts)
    for text, (n_a, n_b, n_groups, groups, pairs, times) in zip(texts, rows):
        a, b, written, links = plain(text)
        assert (n_a, n_b, groups) == (len(a), len(b), written)
        assert n_groups == (written.count(";") + 1 if written else 0)
        want = Counter(x * len(plain.bytes_b) + y for x, y in links)
        assert dict(zip(pairs.tolist(), times.tolist())) == want
