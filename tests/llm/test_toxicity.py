"""The network: gradients, learning, windows and odd rows."""

from __future__ import annotations

import math
import random
import tracemalloc
from collections.abc import Callable

import numpy as np
from tallyworks.llm import toxicity
from tallyworks.llm.toxicity import (HIDDEN, STRIDE, WINDOW, Network, Scorer, grams, keep_clean,
                                     plain, score_documents, sigmoid, train, windows)

FILL = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in "nrst"]


def sample(count: int, seed: int) -> list[tuple[str, int]]:
    draw = random.Random(seed)
    rows = []
    for _ in range(count):
        words = [draw.choice(FILL) for _ in range(draw.randint(3, 150))]
        label = int(draw.random() < 0.3)
        if label:
            words[draw.randrange(len(words))] = draw.choice(["vilezz", "Nastyzz!", "vilezzon"])
        rows.append((" ".join(words), label))
    return rows


def test_gradients_match_differences():
    network = Network({"a": 0, "b": 1}, np.array([0.5, -0.2, 0.0]), 0.0, -1.0, 1)
    network.p = {name: value.astype(np.float64) for name, value in network.p.items()}
    texts, wanted, weight = [["a", "b", "c"], ["b"] * WINDOW], np.array([1.0, 0.0]), np.array([.5, .7])

    def loss() -> float:
        index, mask = np.zeros((2, WINDOW), int), np.zeros((2, WINDOW), bool)
        for row, text in enumerate(texts):
            index[row, :len(text)] = ["abc".index(word) for word in text]
            mask[row, :len(text)] = True
        guess = sigmoid(network.logits(network.inputs(["a", "b", "c"]), index, mask))
        return -(weight * (wanted * np.log(guess) + (1 - wanted) * np.log(1 - guess))).sum()

    for name, gradient in network.gradients(texts, wanted, weight).items():
        flat, at = network.p[name].reshape(-1), int(np.abs(gradient).argmax())
        kept, ends = flat[at], []
        for step in (1e-3, -1e-3):
            flat[at] = kept + step
            ends.append(loss())
        flat[at] = kept
        assert abs((ends[0] - ends[1]) / 2e-3 - gradient.reshape(-1)[at]) < 2e-3, name


def test_windows_overlap_and_reach_both_ends():
    assert windows(0) == [] and windows(5) == [0] and windows(WINDOW) == [0]
    for tokens in (33, 64, 100, 1001):
        starts = windows(tokens)
        assert starts[0] == 0 and starts[-1] == tokens - WINDOW
        assert all(0 < b - a <= STRIDE for a, b in zip(starts, starts[1:]))


def test_grams_belong_to_their_words():
    bucket, word = grams(["idiot", "", "é", "idiot"])
    parts = [bucket[word == at].tolist() for at in range(4)]
    assert parts[0] == parts[3] and all(parts)
    assert parts[0] == grams(["idiot"])[0].tolist()


def test_learns_and_finds_one_word_in_a_long_text():
    network = train(sample(400, 1), {0: 0.7, 1: 0.3}, steps=300)
    held = sample(200, 2)
    scores = Scorer(network)([text for text, _ in held])["score"]
    right = [(score >= 0.3) == bool(label) for score, (_, label) in zip(scores, held)]
    assert np.mean(right) > 0.95
    draw = random.Random(4)
    long = [draw.choice(FILL) for _ in range(20_000)]
    clean, found = Scorer(network)([" ".join(long), " ".join(long[:15_000] + ["vilezz"] + long)])["score"]
    assert found >= 0.3 > clean
    parts = Scorer(network)([" ".join(long), None, "", " "])["score"]
    assert abs(parts[0] - clean) < 1e-6 and parts[1:].tolist() == [0, 0, 0]


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(5, 1, 0), (6, 1, 1), (None, 0, 1), (8, None, None), (9, 1, 0),
                                    (9, 1, 0)], "doc_id long, quality int, toxic int")
    rows = score_documents(odd_documents, labels).collect()
    assert len(rows) == odd_documents.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.score == 0 for r in rows if r.doc_id in (1, 2, 3))
    none = labels.filter("false")
    assert {r.score for r in score_documents(odd_documents, none).collect()} == {0.0}
    assert score_documents(no_documents, labels).count() == 0
    assert keep_clean(odd_documents, none).columns == odd_documents.columns
    assert keep_clean(odd_documents, none).count() == odd_documents.count()


def plain_score(network: Network, text: str) -> float:
    """The highest score of a text's windows, one token and one state at a time."""
    p = {name: value.astype(np.float64) for name, value in network.p.items()}

    def one(x: float) -> float:
        return 1 / (1 + math.exp(-x))

    def entry(token: str) -> np.ndarray:
        word = plain(token)
        buckets = grams([word])[0]
        chars = sum(p["chars"][b] for b in buckets) / math.sqrt(len(buckets))
        return np.concatenate([p["words"][network.vocabulary.get(word, len(p["words"]) - 1)], chars])

    def states(entries: list[np.ndarray], side: str) -> list[list[float]]:
        h, found = [0.0] * HIDDEN, []
        for x in entries:
            into = x @ p[f"{side}_in"] + p[f"{side}_bias"]
            pull = np.array(h) @ p[f"{side}_state"]
            new = []
            for i in range(HIDDEN):
                keep = one(into[i] + pull[i])
                reset = one(into[HIDDEN + i] + pull[HIDDEN + i])
                fresh = math.tanh(into[2 * HIDDEN + i] + reset * pull[2 * HIDDEN + i])
                new.append((1 - keep) * fresh + keep * h[i])
            h = new
            found.append(h)
        return found

    tokens, best = text.split(), 0.0
    for start in windows(len(tokens)):
        entries = [entry(token) for token in tokens[start:start + WINDOW]]
        both = [ahead + back for ahead, back in zip(
            states(entries, "ahead"), states(entries[::-1], "back")[::-1])]
        pull = [math.exp(np.tanh(np.array(h) @ p["attend"]) @ p["query"]) for h in both]
        pooled = sum(w * np.array(h) for w, h in zip(pull, both)) / sum(pull)
        best = max(best, one(pooled @ p["out"] + p["bias"][0]))
    return best


def test_scores_are_those_of_a_plain_forward_pass():
    network = train(sample(120, 8), {0: 0.7, 1: 0.3}, steps=60)
    draw = random.Random(9)
    texts = [" ".join(draw.choice([*FILL, "Vilezz!", "x", "never-seen"]) for _ in range(count))
             for count in (0, 1, 2, WINDOW - 1, WINDOW, WINDOW + 1, 3 * WINDOW + 5)]
    found = Scorer(network)(texts)["score"]
    assert np.allclose(found, [plain_score(network, text) for text in texts], atol=1e-4)


def most_taken(work: Callable) -> int:
    """Bytes that ``work`` holds at most, beside what there was."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_gate_inputs_take_little_beside_themselves():
    network = train(sample(40, 3), {0: 0.7, 1: 0.3}, steps=8)
    words = [f"{a}{b}{c}" for a in FILL for b in FILL for c in range(4)]
    scorer = Scorer(network)
    made = network.inputs(words).nbytes
    assert most_taken(lambda: network.inputs(words)) < 2 * made
    scorer([" ".join(words)])
    assert most_taken(lambda: scorer([" ".join(words[:3])])) < made / 2  # all known
    few = network.inputs(words[:5] + words[-5:])
    assert np.allclose(few, np.concatenate([network.inputs(words)[:, :5],
                                            network.inputs(words)[:, -5:]], 1), atol=1e-5)


def test_training_holds_equal_tokens_once(monkeypatch):
    held, untrained = [], toxicity._untrained

    def watched(texts, *rest):
        held.extend(token for tokens in texts for token in tokens)
        return untrained(texts, *rest)
    monkeypatch.setattr(toxicity, "_untrained", watched)
    train(sample(40, 3), {0: 0.7, 1: 0.3}, steps=8)
    assert len(held) > len(set(held)) == len(set(map(id, held)))
