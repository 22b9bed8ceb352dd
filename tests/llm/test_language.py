"""Language ID: kernel algebra, held-out accuracy, odd rows."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
from tallyworks.llm.language import PIECE, SPACE, fit, identify, keep_known, ngrams

SYLLABLES = {"aa": ["ka", "ri", "mo", "tu"], "bb": ["sch", "eng", "ung", "ach"],
             "cc": ["éu", "ré", "ion", "que"]}


def sample(count: int, seed: int) -> list[tuple[str, str]]:
    draw = random.Random(seed)
    rows = []
    for _ in range(count):
        lang = draw.choice(sorted(SYLLABLES))
        words = ["".join(draw.choices(SYLLABLES[lang], k=draw.randint(1, 4)))
                 for _ in range(draw.randint(3, 60))]
        rows.append((" ".join(words), lang))
    return rows


def test_held_out_accuracy():
    score = fit(sample(200, 1)).scorer()
    held = sample(200, 2)
    found = score([text for text, _ in held])
    assert np.mean([a == b for a, (_, b) in zip(found["lang_pred"], held)]) > 0.98
    assert all(0 <= s <= 1 for s in found["score"])


def test_scorer_takes_no_table_of_all_codes():
    """Columns of features are found in a tenth of four bytes a code."""
    model = fit(sample(200, 1))
    tracemalloc.start()
    model.scorer()(["ka ri mo"])
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < SPACE * 4 // 10
    want = np.full(SPACE, -1)
    want[model.features] = np.arange(len(model.features))
    assert (model.places()(np.arange(SPACE, dtype=np.int32)) == want).all()
    assert (fit([]).places()(np.arange(SPACE, dtype=np.int32)) == -1).all()


def test_ngrams_are_those_of_the_whole_text():
    text = "Äb, cd " * 3
    data = text.lower().encode()
    plain = {data[i:i + n] for n in (1, 2, 3) for i in range(len(data) - n + 1)}
    assert len(ngrams(text)) == len(plain)
    long = "a" * (PIECE - 2) + "bcdef" + "a" * PIECE
    assert set(ngrams("abcdefa")) <= set(ngrams(long))


def test_table(documents):
    truth = {r.doc_id: r.lang for r in documents.collect()}
    rows = identify(documents).collect()
    held = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert len(rows) == len(truth) and np.mean(held) > 0.95


def test_odd_rows(odd_documents, no_documents):
    rows = identify(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    for row in rows:
        assert (row.lang_pred == "und") == (row.doc_id in (1, 2, 3, 4)), row
        assert 0 <= row.score <= 1 and (row.lang_pred != "und" or row.score == 0)
    assert identify(no_documents).count() == 0
    kept = keep_known(odd_documents)
    assert kept.columns == odd_documents.columns and kept.count() == odd_documents.count() - 4
    assert identify(odd_documents.selectExpr("doc_id", "text", "null AS lang")).filter(
        "lang_pred <> 'und' or score <> 0").count() == 0


def plain_grams(text: str) -> set[bytes]:
    data = text.lower().encode()
    return {data[i:i + n] for n in (1, 2, 3) for i in range(len(data) - n + 1)}


def test_scores_are_those_of_plain_kernel_ridge():
    """Against ridge regression in the dual, from kernel values of sets of byte strings."""
    known, asked = sample(60, 5), [text for text, _ in sample(30, 6)]
    for landmarks in (60, 25):
        marks = [plain_grams(known[i][0])
                 for i in np.random.default_rng(7).permutation(60)[:landmarks]]
        features = {g for own in marks for g in own if sum(g in other for other in marks) > 1}

        def kernel(left: list[set], right: list[set]) -> np.ndarray:
            return np.array([[len(a & b & features)
                              / (max(len(a & features), 1) * max(len(b & features), 1)) ** 0.5
                              for b in right] for a in left])

        rows = [plain_grams(text) for text, _ in known]
        among = np.linalg.pinv(kernel(marks, marks), rcond=1e-6, hermitian=True)
        seen, new = kernel(rows, marks), kernel([plain_grams(text) for text in asked], marks)
        languages = sorted(SYLLABLES)
        wanted = np.array([[1.0 if own == lang else -1.0 for lang in languages]
                           for _, own in known])
        whole, middle = seen @ among @ seen.T, np.eye(60) - 1 / 60
        dual = np.linalg.solve(middle @ whole @ middle + 1e-3 * 60 * np.eye(60), middle @ wanted)
        bias = (wanted - whole @ middle @ dual).mean(0)
        values = new @ among @ seen.T @ middle @ dual + bias
        found = fit(known, landmarks=landmarks).scorer()(asked)
        assert found["lang_pred"] == [languages[i] for i in values.argmax(1)]
        assert np.allclose(found["score"], np.clip((values.max(1) + 1) / 2, 0, 1), atol=2e-3)
        assert found["claimed"] == (values > bias).any(1).tolist()
