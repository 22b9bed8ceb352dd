"""Language ID by string kernels.

Two texts are compared by the n-grams they share: of the bytes of their lower-case UTF-8, of
lengths 1 to 3, each counted as present or not (blended-spectrum presence kernel, normalised).
Landmarks stand for all texts (Nystroem); one ridge regression a language against the rest is
fitted on the landmarks' kernel values.  A prediction is linear in a text's n-grams, so that
landmarks and weights fold into one matrix: a batch of texts is scored by one product of
its presence matrix with that.

The sample to fit on is bounded by ``per_language`` and ``longest``; every text is scored
whole.

Defined results: null text, or text without a letter, is ``und`` with score 0; so is every
text if no language can be learned; equal scores go to the first language in order; rows
repeat as they come; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.samples import classify, held_out, sample_texts

UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
LENGTHS = (1, 2, 3)
PIECE, ROWS = 1 << 20, 256
SPACE = 1 << 8 * max(LENGTHS)


def _codes(data: np.ndarray) -> list[np.ndarray]:
    """Codes of the n-grams of each length; lengths do not share codes."""
    whole = data.astype(np.int32) + 1
    found, code = [], whole
    for length in LENGTHS:
        if length > 1:
            code = code[:-1] * 256 + whole[length - 1:]
        found.append(code % SPACE)
    return found


def _pieces(text: str):
    data = np.frombuffer(text.lower().encode(), np.uint8)
    for at in range(0, max(len(data), 1), PIECE):
        yield data[at:at + PIECE + max(LENGTHS) - 1]


def ngrams(text: str) -> np.ndarray:
    """The distinct n-gram codes of a whole text."""
    return np.unique(np.concatenate([code for piece in _pieces(text) for code in _codes(piece)]))


class Model:
    """Weights per n-gram and language."""

    def __init__(self, languages: list[str], features: np.ndarray, weights: np.ndarray,
                 bias: np.ndarray):
        self.languages, self.features = languages, features
        self.weights, self.bias = weights, bias

    def places(self) -> Callable[[np.ndarray], np.ndarray]:
        """Gives the column of each code, -1 for what is no feature.

        A block of 256 columns for each beginning that some feature has, found by that beginning;
        the first is for all others.  A table of all codes would take 64 MB of every worker.
        """
        begun, block = np.unique(self.features >> 8, return_inverse=True)
        starts = np.zeros(SPACE >> 8, np.int32)
        starts[begun] = 256 * np.arange(1, len(begun) + 1)
        columns = np.full(256 * (len(begun) + 1), -1, np.int32)
        columns[256 * (block + 1) + (self.features & 255)] = np.arange(len(self.features))
        return lambda codes: columns.take(starts.take(codes >> 8) + (codes & 255))

    def scorer(self):
        places = self.places()

        def of_texts(texts: list[str | None]) -> dict:
            known = [bool(text) and bool(LETTER.search(text)) for text in texts]
            found = {"lang_pred": [], "score": [], "claimed": []}
            for at in range(0, len(texts), ROWS):
                part = [text if ok else "" for text, ok in
                        zip(texts[at:at + ROWS], known[at:at + ROWS])]
                present = np.zeros((len(part), len(self.features) + 1), np.float32)
                for row, text in enumerate(part):
                    for piece in _pieces(text):
                        for code in _codes(piece):
                            present[row, places(code)] = 1
                present = present[:, :-1]  # the last took what is no feature
                present /= np.sqrt(np.maximum(present.sum(1, keepdims=True), 1))
                scores = present @ self.weights + self.bias
                for ok, values in zip(known[at:at + ROWS], scores):
                    best = int(values.argmax()) if ok and self.languages else None
                    found["lang_pred"].append(UNKNOWN if best is None else self.languages[best])
                    found["score"].append(0.0 if best is None else
                                          float(np.clip((values[best] + 1) / 2, 0, 1)))
                    found["claimed"].append(best is not None and
                                            bool((values > self.bias).any()))
            return found
        return of_texts


def fit(sample: list[tuple[str, str]], landmarks: int = 256, ridge: float = 1e-3,
        seed: int = 7) -> Model:
    """Ridge regression in the space the landmarks span."""
    sample = [(text, label) for text, label in sample if LETTER.search(text)]
    languages = sorted({label for _, label in sample})
    if not languages:
        return Model([], np.zeros(0, np.int64), np.zeros((0, 1), np.float32),
                     np.zeros(1, np.float32))
    chosen = np.random.default_rng(seed).permutation(len(sample))[:landmarks]
    sets = [ngrams(text) for text, _ in sample]
    features, seen = np.unique(np.concatenate([sets[i] for i in chosen]), return_counts=True)
    features = features[seen >= min(2, len(chosen))]
    present = np.zeros((len(sample), len(features)), np.float32)
    for row, codes in enumerate(sets):
        present[row] = np.isin(features, codes)
    present /= np.sqrt(np.maximum(present.sum(1, keepdims=True), 1))
    marks = present[chosen]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])  # the kernel's inverse square root
    space = (present @ marks.T).astype(np.float64) @ root
    space = np.hstack([space, np.ones((len(sample), 1))])
    wanted = np.where(np.array([label for _, label in sample])[:, None] == languages, 1.0, -1.0)
    damping = ridge * len(sample) * np.eye(space.shape[1])
    damping[-1, -1] = 0
    solved = np.linalg.solve(space.T @ space + damping, space.T @ wanted)
    weights = marks.T.astype(np.float64) @ (root @ solved[:-1])
    return Model(languages, features, weights.astype(np.float32), solved[-1].astype(np.float32))


def learn(docs: DataFrame, per_language: int = 300, longest: int = 20_000) -> Model:
    return fit(sample_texts(docs, docs.select("doc_id", F.col("lang").alias("label")),
                            per_language, longest))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` as column ``row`` beside lang_pred, score and claimed: whether its n-grams
    speak for any language at all."""
    return classify(docs, model.scorer, ("lang_pred", "score", "claimed"),
                    "lang_pred string, score double, claimed boolean")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    return predict(docs.select("doc_id", "text"), learn(docs)).select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, languages: Iterable[str] | None = None) -> DataFrame:
    """The documents in one of ``languages``, of all that are learned by default.

    A document goes if it has no letter, is in another language, or if its n-grams speak
    against every language.  All stay if fewer than two languages can be learned, as there is
    nothing to tell then.
    """
    model = learn(docs)
    if len(model.languages) < 2:
        return docs
    wanted = model.languages if languages is None else list(languages)
    return predict(docs, model).filter(
        F.col("lang_pred").isin(wanted) & F.col("claimed")).select("row.*")
