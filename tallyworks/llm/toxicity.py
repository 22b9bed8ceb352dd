"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A token goes in as a word vector (words of the training sample, all others share one) and the
scaled sum of the vectors of its hashed character n-grams.  A gated recurrent unit runs over a
window of tokens from either side; attention pools the states; one number comes out.  A
text's score is the largest over all its overlapping windows, whole texts always.

Training is plain numpy with Adam, on a bounded sample of labelled rows weighted back to the
classes' true shares.  A label belongs to a text, not to a window, so each round trains on
the window that scores highest in its text, and on one more at random.  The first component
of a vector starts as the smoothed log odds of its word or n-gram in the sample.

The input of a token is linear up to the gates, so a task keeps the gate inputs of the tokens
it has met, up to a bound.

Defined results: null or empty text has no window and scores 0; without labelled rows every
text scores 0; rows repeat as they come; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.samples import HELD_OUT, classify, held_out, remainder, sample_texts
from tallyworks.llm.shingles import give_back

WINDOW, STRIDE = 32, 16
WORD_SIZE, CHAR_SIZE, HIDDEN, ATTENTION = 8, 8, 8, 8
LENGTHS, GRAM_BITS = (3, 4), 16  # of character n-grams, and of their buckets
THRESHOLD = 0.3
MEMORY = 100_000
MOST_ROUNDS = 60
ROWS = 2048
TOKENS = 4096  # whose gate inputs are made together
EDGES = "".join(chr(i) for i in range(33, 127) if not chr(i).isalnum())
GATES = 3 * HIDDEN


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def plain(token: str) -> str:
    return token.lower().strip(EDGES)


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and word of every byte n-gram of the words, marked at both ends."""
    whole = "\0".join(f"^{word.replace(chr(0), ' ') or ' '}$" for word in words)
    data = np.frombuffer(whole.encode(), np.uint8).astype(np.uint32)
    word = np.cumsum(data == 0)
    code, ends = data, data == 0
    buckets, of = [], []
    for length in range(2, max(LENGTHS) + 1):
        code = (code[:-1] << np.uint32(8)) | data[length - 1:]
        ends = ends[:-1] | (data[length - 1:] == 0)
        if length in LENGTHS:
            inside = ~ends
            mixed = (code[inside] + np.uint32(length)) * np.uint32(2654435761)
            buckets.append((mixed >> np.uint32(32 - GRAM_BITS)).astype(np.int64))
            of.append(word[:len(code)][inside])
    bucket, of = np.concatenate(buckets), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return bucket[order], of[order]


def added(rows: int, place: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of the values by place."""
    return np.stack([np.bincount(place, column, rows) for column in values.T], 1)


def windows(tokens: int) -> list[int]:
    """Starts of the overlapping windows; the last one ends with the text."""
    if tokens <= WINDOW:
        return [0] if tokens else []
    starts = list(range(0, tokens - WINDOW, STRIDE))
    return [*starts, tokens - WINDOW]


class Network:
    """Parameters, scores and gradients."""

    def __init__(self, vocabulary: dict[str, int], odds: np.ndarray, gram_odds: np.ndarray,
                 bias: float, seed: int):
        draw = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return draw.normal(0, scale, shape).astype(np.float32)

        size = WORD_SIZE + CHAR_SIZE
        self.vocabulary = vocabulary
        words = normal(len(vocabulary) + 1, WORD_SIZE, scale=0.1)
        words[:, 0] = odds
        chars = normal(1 << GRAM_BITS, CHAR_SIZE, scale=0.1)
        chars[:, 0] = gram_odds
        self.p = {
            "words": words, "chars": chars,
            "attend": normal(2 * HIDDEN, ATTENTION, scale=0.3),
            "query": normal(ATTENTION, scale=0.3), "out": normal(2 * HIDDEN, scale=0.3),
            "bias": np.full(1, bias, np.float32)}
        for side in ("ahead", "back"):
            self.p |= {f"{side}_in": normal(size, GATES, scale=size ** -0.5),
                       f"{side}_state": normal(HIDDEN, GATES, scale=HIDDEN ** -0.5),
                       f"{side}_bias": np.zeros(GATES, np.float32)}

    def features(self, words: list[str]) -> tuple[np.ndarray, tuple]:
        """What goes in for each word, and where it comes from."""
        none = len(self.vocabulary)
        places = np.array([self.vocabulary.get(word, none) for word in words], np.int64)
        bucket, word = grams(words)
        counts = np.bincount(word, minlength=len(words))
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        counts = np.sqrt(counts)
        chars = np.add.reduceat(self.p["chars"][bucket], first) / counts[:, None]
        x = np.hstack([self.p["words"][places], chars]).astype(self.p["words"].dtype)
        return x, (places, bucket, word, counts)

    def inputs(self, words: list[str]) -> np.ndarray:
        """Gate inputs of both directions, in each one row a word."""
        made = np.empty((2, len(words), GATES), self.p["words"].dtype)
        for at in range(0, len(words), TOKENS):
            x, _ = self.features(words[at:at + TOKENS])
            for part, side in zip(made, ("ahead", "back")):
                part[at:at + TOKENS] = x @ self.p[f"{side}_in"] + self.p[f"{side}_bias"]
        return made

    def _side(self, gates, state, mask, order, kept):
        """States of one direction in order of time; ``kept`` takes what gradients need."""
        rows = gates(0).shape[0]
        h = np.zeros((rows, HIDDEN), np.float32)
        states = np.empty((len(order), rows, HIDDEN), np.float32)
        for t in order:
            x, pull = gates(t), h @ state
            zr = sigmoid(x[:, :2 * HIDDEN] + pull[:, :2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = np.tanh(x[:, 2 * HIDDEN:] + r * pull[:, 2 * HIDDEN:])
            new = n + z * (h - n)
            if mask is not None:
                new = np.where(mask[:, t, None], new, h)
            if kept is not None:
                kept.append((t, h, z, r, n, pull[:, 2 * HIDDEN:]))
            h = states[t] = new
        return states

    def logits(self, table: np.ndarray, index: np.ndarray, mask: np.ndarray | None,
               kept: dict | None = None) -> np.ndarray:
        """One number a window.  ``table`` has gate inputs, ``index`` a row of theirs a token."""
        steps = range(index.shape[1])
        notes = ([], []) if kept is not None else (None, None)
        ahead, back = table
        states = np.concatenate([
            self._side(lambda t: ahead[index[:, t]], self.p["ahead_state"], mask, steps, notes[0]),
            self._side(lambda t: back[index[:, t]], self.p["back_state"], mask, steps[::-1],
                       notes[1])], axis=2)
        u = np.tanh(states @ self.p["attend"])
        s = u @ self.p["query"]
        if mask is not None:
            s = np.where(mask.T, s, -1e9)
        a = np.exp(s - s.max(0))
        a /= a.sum(0)
        pooled = (a[..., None] * states).sum(0)
        if kept is not None:
            kept |= {"states": states, "u": u, "a": a, "pooled": pooled, "notes": notes}
        return pooled @ self.p["out"] + self.p["bias"]

    def gradients(self, words: list[list[str]], wanted: np.ndarray,
                  weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the weighted log loss over windows of words."""
        distinct = sorted({word for window in words for word in window})
        place = {word: i for i, word in enumerate(distinct)}
        index = np.zeros((len(words), WINDOW), np.int64)
        mask = np.zeros(index.shape, bool)
        for row, window in enumerate(words):
            index[row, :len(window)] = [place[word] for word in window]
            mask[row, :len(window)] = True
        kept: dict = {}
        out = self.logits(self.inputs(distinct), index, mask, kept)
        p, g = self.p, {name: np.zeros_like(value) for name, value in self.p.items()}
        d_out = ((sigmoid(out) - wanted) * weight).astype(np.float32)
        states, u, a = kept["states"], kept["u"], kept["a"]
        g["out"], g["bias"] = kept["pooled"].T @ d_out, d_out.sum(keepdims=True)
        d_pooled = d_out[:, None] * p["out"]
        d_states = a[..., None] * d_pooled
        d_a = (states * d_pooled).sum(2)
        d_s = a * (d_a - (a * d_a).sum(0))
        g["query"] = np.einsum("tb,tba->a", d_s, u)
        d_u = d_s[..., None] * p["query"] * (1 - u * u)
        g["attend"] = np.einsum("tbh,tba->ha", states, d_u)
        d_states += d_u @ p["attend"].T
        d_table = []
        for side, notes, first in (("ahead", kept["notes"][0], 0), ("back", kept["notes"][1], 1)):
            state = p[f"{side}_state"]
            carried = np.zeros((len(words), HIDDEN), np.float32)
            d_gates = np.zeros((*index.shape, GATES), np.float32)
            for t, h, z, r, n, pull in reversed(notes):
                d_h = d_states[t][:, first * HIDDEN:(first + 1) * HIDDEN] + carried
                real = mask[:, t, None]
                d_new = np.where(real, d_h, 0)
                d_n = d_new * (1 - z) * (1 - n * n)
                d_z = d_new * (h - n) * z * (1 - z)
                d_r = d_n * pull * r * (1 - r)
                d_gates[:, t] = np.hstack([d_z, d_r, d_n])
                d_pull = np.hstack([d_z, d_r, d_n * r])
                g[f"{side}_state"] += h.T @ d_pull
                carried = np.where(real, d_new * z + d_pull @ state.T, d_h)
            d_table.append(added(len(distinct), index.ravel(), d_gates.reshape(-1, GATES)))
        x, (places, bucket, word, counts) = self.features(distinct)
        d_x = np.zeros_like(x)
        for part, side in zip(d_table, ("ahead", "back")):
            g[f"{side}_in"], g[f"{side}_bias"] = x.T @ part, part.sum(0)
            d_x += part @ p[f"{side}_in"].T
        g["words"] = added(len(p["words"]), places, d_x[:, :WORD_SIZE])
        g["chars"] = added(1 << GRAM_BITS, bucket, (d_x[:, WORD_SIZE:] / counts[:, None])[word])
        return g


class Scorer:
    """Scores whole texts with a network, keeping the gate inputs of tokens it has met."""

    def __init__(self, network: Network):
        self.network = network
        self.forget()

    def forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.table = np.zeros((2, 0, GATES), np.float32)

    def _index(self, texts: list[list[str]]) -> list[np.ndarray]:
        if len(self.rows) > MEMORY:
            self.forget()
        new = sorted({token for tokens in texts for token in tokens}.difference(self.rows))
        if new:
            self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
            made = self.network.inputs([plain(t) for t in new])
            self.table = np.concatenate([self.table, made], 1) if self.table.size else made
        row = self.rows.__getitem__
        return [np.fromiter(map(row, tokens), np.int64, len(tokens)) for tokens in texts]

    def windows(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, start and logit of every window."""
        indexes = self._index(texts)
        starts = [windows(len(tokens)) for tokens in texts]
        text = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
        start = np.array([at for s in starts for at in s], np.int64)
        out = np.zeros(len(text), np.float32)
        sizes = np.array([len(tokens) for tokens in texts] or [0])
        short = sizes[text] < WINDOW if len(text) else np.zeros(0, bool)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        flat = np.concatenate([*indexes, np.zeros(WINDOW, np.int64)])
        for padded in (False, True):
            which = np.nonzero(short == padded)[0]
            for at in range(0, len(which), ROWS):
                part = which[at:at + ROWS]
                places = (ends[text[part]] + start[part])[:, None] + np.arange(WINDOW)
                mask = np.arange(WINDOW) < sizes[text[part], None] if padded else None
                out[part] = self.network.logits(self.table, flat[places], mask)
        return text, start, out

    def __call__(self, texts: list[str | None]) -> dict:
        scores, part, tokens = np.zeros(len(texts)), [], 0
        for row, text in enumerate(texts):
            part.append((text or "").split())
            tokens += len(part[-1])
            if tokens > ROWS * STRIDE or row == len(texts) - 1:
                first = row + 1 - len(part)
                of, _, out = self.windows(part)
                np.maximum.at(scores, first + of, sigmoid(out.astype(np.float64)))
                part, tokens = [], 0
        return {"score": scores}


def _odds(toxic: np.ndarray, every: np.ndarray, base: float, doubt: float) -> np.ndarray:
    """Log odds of features by the texts that hold them, as if ``doubt`` of base rate came on top."""
    rate = np.clip((toxic + doubt * base) / (every + doubt), 1e-3, 1 - 1e-3)
    return np.log(rate / (1 - rate)) - np.log(base / (1 - base))


def _untrained(texts: list[list[str]], labels: np.ndarray, weight: np.ndarray, base: float,
               least_texts: int, doubt: float, seed: int) -> Network:
    """A network that knows the log odds of words and n-grams."""
    seen: Counter[str] = Counter()
    counts: dict[str, np.ndarray] = {}
    by_gram = np.zeros((2, 1 << GRAM_BITS))
    for tokens, label, w in zip(texts, labels, weight):
        words = sorted({plain(token) for token in tokens})
        for word in words:
            counts[word] = counts.get(word, 0) + np.array([w * label, w])
        seen.update(words)
        by_gram[:, np.unique(grams(words)[0])] += [[w * label], [w]]
    names = sorted(word for word, n in seen.items() if n >= least_texts)
    by_word = np.array([counts[word] for word in names]).reshape(-1, 2).T
    return Network(dict(zip(names, range(len(names)))),
                   np.append(_odds(*by_word, base, doubt), 0), _odds(*by_gram, base, doubt),
                   float(np.log(base / (1 - base))), seed)


def train(sample: list[tuple[str, int]], shares: dict[int, float], steps: int = 560,
          batch: int = 32, rate: float = 0.01, least_texts: int = 3, doubt: float = 20,
          back: float = 0.2, seed: int = 11) -> Network | None:
    """A network from (text, label); ``shares`` are the labels' shares of all labelled rows.

    About ``steps`` batches are learned from, or what MOST_ROUNDS rounds over the sample give.  A fifth of the sample is kept back: the
    parameters that predict it best are returned.
    """
    once: dict[str, str] = {}  # equal tokens of the sample are one object
    texts = [[once.setdefault(token, token) for token in text.split()] for text, _ in sample]
    labels = np.array([label for _, label in sample], np.float32)
    if not len(labels):
        return None
    draw = np.random.default_rng(seed)
    present = {label: max((labels == label).mean(), 1e-9) for label in (0, 1)}
    weight = np.array([shares[label] / present[label] for label in labels.astype(int)], np.float32)
    base = float(np.clip(shares.get(1, 0.0), 0.001, 0.999))
    checked = np.zeros(len(labels), bool)
    for label in (0, 1):
        own = draw.permutation(np.nonzero(labels == label)[0])
        checked[own[:int(len(own) * back)]] = True
    network = _untrained([t for t, c in zip(texts, checked) if not c], labels[~checked],
                         weight[~checked], base, least_texts, doubt, seed)
    moments = {name: [np.zeros_like(v), np.zeros_like(v)] for name, v in network.p.items()}
    least, kept, step = np.inf, network.p, 0
    rounds = min(max(8, steps * batch // len(texts)), MOST_ROUNDS)
    for turn in range(rounds + 1):
        give_back()  # the driver keeps its session beside this
        of, start, out = Scorer(network).windows(texts)
        order = np.lexsort((out, of))
        best = order[np.append(of[order][1:] != of[order][:-1], True)]
        guess = np.clip(sigmoid(out[best]), 1e-6, 1 - 1e-6)
        known = labels[of[best]]
        loss = -(weight[of[best]] * (known * np.log(guess) + (1 - known) * np.log(1 - guess)))
        loss = float(loss[checked[of[best]]].sum())
        if loss < least or not back:
            least, kept = loss, {name: value.copy() for name, value in network.p.items()}
        if turn == rounds:
            break
        others = draw.choice(len(of), min(len(of), len(best) // 2), False)
        chosen = np.concatenate([best, others[labels[of[others]] == 0]])
        chosen = chosen[~checked[of[chosen]]]
        draw.shuffle(chosen)
        for at in range(0, len(chosen), batch):
            part = chosen[at:at + batch]
            words = [[plain(t) for t in texts[of[i]][start[i]:start[i] + WINDOW]] for i in part]
            gradients = network.gradients(words, labels[of[part]], weight[of[part]] / len(part))
            step += 1
            size = rate * (1 - turn / rounds)
            for name, g in gradients.items():
                first, second = moments[name]
                first += 0.1 * (g - first)
                second += 0.001 * (g * g - second)
                moved = first / (1 - 0.9 ** step) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
                network.p[name] -= (size * moved).astype(network.p[name].dtype)
    network.p = kept
    return network


def learn(docs: DataFrame, labels: DataFrame, per_label: int = 1500,
          longest: int = 8_000) -> Network | None:
    marked = labels.filter(F.col("toxic").isin(0, 1) & (remainder(F.col("doc_id")) != HELD_OUT)
                           ).select("doc_id", F.col("toxic").alias("label"))
    ids = docs.select(F.col("doc_id").alias("_id"))
    marked = marked.join(ids, F.col("doc_id") == F.col("_id"), "left_semi")
    counts = {row.label: row["count"] for row in marked.groupBy("label").count().collect()}
    sample = sample_texts(docs, marked, per_label, longest)
    total = sum(counts.values())
    return train(sample, {label: n / total for label, n in counts.items()})


def _nothing(texts: list[str | None]) -> dict:
    return {"score": [0.0] * len(texts)}


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """``docs`` as column ``row`` beside its score."""
    return classify(docs, lambda: Scorer(network) if network else _nothing, ("score",),
                    "score double")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    scored = predict(docs.select("doc_id", "text"), learn(docs, labels))
    return scored.select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score under the threshold."""
    return predict(docs, learn(docs, labels)).filter(F.col("score") < THRESHOLD).select("row.*")
