"""Runs against trying every stretch and period."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st
from tallyworks.llm.periodic_runs import collapse, digest_runs, find_runs, periodic_runs


def smallest_period(words) -> int:
    return next(q for q in range(1, len(words) + 1)
                if all(words[i] == words[i - q] for i in range(q, len(words))))


def brute_force(words, least=6, times=4):
    found = []
    for start in range(len(words)):
        for end in range(start + least, len(words) + 1):
            q = smallest_period(words[start:end])
            if end - start < max(least, times * q):
                continue
            if start and words[start - 1] == words[start - 1 + q]:
                continue
            if end < len(words) and words[end] == words[end - q]:
                continue
            found.append((start, end - start, q))
    return found


def dropped(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [word for i, word in enumerate(words) if i not in gone]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=28), st.lists(st.sampled_from("abc"), max_size=5),
       st.integers(1, 7), st.lists(st.sampled_from("abc"), max_size=8))
def test_any_words(before, root, rounds, after):
    words = before + root * rounds + after
    runs = find_runs(words)
    assert runs == brute_force(words)
    assert collapse(words, runs) == dropped(words, runs)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=24), st.sampled_from([(2, 2), (3, 2), (9, 3),
                                                                      (20, 4), (2, 5)]))
def test_other_bounds(words, bounds):
    words = words * 2
    assert find_runs(words, *bounds) == brute_force(words, *bounds)


def test_nested_and_wide_runs():
    """Roots that hold runs of their own, and periods of every window width."""
    draw = random.Random(8)
    for size in (1, 5, 6, 17, 18, 19, 57, 58, 174, 175, 600):
        root = [draw.choice("abcdefgh") for _ in range(size)]
        words = [draw.choice("xyz") for _ in range(9)] + root * 6 + root[:size // 2] + ["end"]
        q = smallest_period(root * 6)
        assert any(run[1] >= 6 * size and run[2] == q for run in find_runs(words))
    root = "a a a a a a a b".split()
    assert (0, 80, 8) in find_runs(root * 10) and (0, 7, 1) in find_runs(root * 10)


def test_time_is_linear_in_repeats():
    """Words that all occur again at every place."""
    for words in (["a"] * 300_000, "a a a a a a a b".split() * 40_000,
                  [str(i % 70_000) for i in range(300_000)]):
        began = time.process_time()
        runs = find_runs(words)
        assert runs and time.process_time() - began < 20


def planted_words(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def wanted(doc_id, text, runs_of):
    words = planted_words(doc_id, text)
    runs = runs_of(words)
    best = (None,) * 4
    for s, n, q in runs:
        if best[0] is None or n * best[2] > best[1] * q:
            best = (s, n, q, 1000 * n // q)
    return (doc_id, len(runs), *best, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            digest(" ".join(dropped(words, runs))))


def diagonals(words):
    """Every lag on its own, word by word: no windows, no ranks."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        start = 0
        for i in range(q, n + 1):
            if i == n or words[i] != words[i - q]:
                if i - start >= max(6, 4 * q) and smallest_period(words[start:i]) == q:
                    found.append((start, i - start, q))
                start = i - q + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_diagonals_are_a_brute_force():
    draw = random.Random(2)
    for _ in range(200):
        words = [draw.choice("ab") for _ in range(draw.randrange(30))]
        assert diagonals(words) == brute_force(words)


def test_query(spark, documents):
    rows = [r for r in documents.collect() if len(r.text or "") < 6000]
    found = {tuple(r) for r in digest_runs(documents).collect()}
    assert len(found) == documents.count()
    assert {wanted(r.doc_id, r.text, diagonals) for r in rows} <= found
    assert sum(r[1] > 0 for r in found) > len(found) / 20


def test_odd_rows(spark, odd_documents, no_documents):
    found = sorted(map(str, (tuple(r) for r in digest_runs(odd_documents).collect())))
    assert found == sorted(str(wanted(r.doc_id, r.text, find_runs))
                           for r in odd_documents.collect())
    assert digest_runs(no_documents).count() == 0


def test_real_outputs(spark):
    text = "so it goes " * 5 + "and on"
    docs = spark.createDataFrame([(1, text), (2, None), (2, None)], "doc_id long, text string")
    rows = sorted(periodic_runs(docs).collect())
    assert [tuple(run) for run in rows[0].runs] == [(0, 15, 3)]
    assert rows[0].collapsed == "so it goes and on"
    assert [(r.runs, r.collapsed) for r in rows[1:]] == [([], "")] * 2
