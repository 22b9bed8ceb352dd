"""Periodic runs of words, and texts without what they repeat.

A run is a stretch of words with smallest period q, of at least ``least`` words and
``times`` periods, that no neighbouring word extends.  Within a run every word agrees with
the one q words before: an online dynamic program over diagonals.  For each word its earlier
occurrence increments the match length of its lag, and a diagonal that ends emits its
run at once.

The program is sparse: an occurrence counts with the words that follow it.  A run of period
q agrees over at least ``least(q)`` words at lag q, so a word whose window of that many
words occurred nowhere before is on no diagonal; and where the window is at least q words wide,
the nearest earlier occurrence of it within the run is at lag q exactly, as a nearer one
would make the lag a smaller period.  One window serves the lags up to its width, so windows of
about 5, 18, 57, ... words serve all lags, and each word has one occurrence at each
width.  Windows are told apart by exact ranks (pairs of ranks of narrower windows), only where
the narrower windows recur.  Time is n log n at worst, whatever the text repeats.

Defined results: null, empty or blank text has no words and no runs, and an empty collapsed
text; repeated rows give repeated results; an empty table gives no rows; a null doc_id is
carried along.  Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.shingles import slices

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
WORDS = r"([^\x20\x09-\x0D]+)"


def windows(n: int, least: int, times: int) -> Iterator[tuple[int, int, int]]:
    """(width, first lag, last lag) of the windows that find all runs among ``n`` words."""
    first = 1
    while max(least, times * first) <= n:
        width = min(max(least, times * lag) - lag for lag in range(first, first + least + 1))
        yield width, first, width
        first = width + 1


class Ranks:
    """Equal ranks for equal windows, kept at places whose window recurs."""

    def __init__(self, codes: np.ndarray):
        self.width, self.rank = 1, codes
        self.places = np.arange(len(codes))

    def widen(self, width: int) -> None:
        while self.width < width:
            shift = min(self.width, width - self.width)
            places = self.places[self.places < len(self.rank) - shift]
            other = self.rank[places + shift]
            places, other = places[other >= 0], other[other >= 0]
            pair = self.rank[places] * np.int64(len(self.rank) + 1) + other
            _, rank, count = np.unique(pair, return_inverse=True, return_counts=True)
            recurs = count[rank] > 1
            self.places, self.width = places[recurs], self.width + shift
            self.rank = np.full(len(self.rank), -1, np.int64)
            self.rank[self.places] = rank[recurs]

    def lags(self) -> tuple[np.ndarray, np.ndarray]:
        """Places with an earlier occurrence of their window, and how far back it is."""
        order = self.places[np.argsort(self.rank[self.places], kind="stable")]
        same = self.rank[order[1:]] == self.rank[order[:-1]]
        places, lags = order[1:][same], np.diff(order)[same]
        ahead = np.argsort(places)
        return places[ahead], lags[ahead]


def find_runs(words: Sequence, least: int = 6, times: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run among ``words``, by start, then period."""
    if least < 2 or times < 2:
        raise ValueError("a run has at least two words and two periods")
    number = {word: code for code, word in enumerate(dict.fromkeys(words))}
    n, runs = len(words), []
    ranks = Ranks(np.fromiter(map(number.__getitem__, words), np.int64, n))

    def ended(lag: int, first: int, last: int, width: int) -> None:
        start, end = first - lag, last + width
        maximal = ((start == 0 or words[start - 1] != words[first - 1])
                   and (end == n or words[end] != words[end - lag]))
        if maximal and end - start >= max(least, times * lag):
            runs.append((start, end - start, lag))

    for width, shortest, longest in windows(n, least, times):
        ranks.widen(width)
        if not len(ranks.places):
            break
        places, lags = ranks.lags()
        near = (lags >= shortest) & (lags <= longest)
        active = first = last = -1
        for place, lag in zip(places[near].tolist(), lags[near].tolist()):
            if lag != active or place != last + 1:
                if active > 0:
                    ended(active, first, last, width)
                active, first = lag, place
            last = place
        if active > 0:
            ended(active, first, last, width)
    return sorted(runs, key=lambda run: (run[0], run[2]))


def collapse(words: Sequence, runs: list[tuple[int, int, int]]) -> list:
    """The words without what any run holds after its first period."""
    kept, at = [], 0
    for start, end in sorted((start + period, start + length) for start, length, period in runs):
        kept += words[at:max(at, start)]
        at = max(at, end)
    return kept + list(words[at:])


def _finder(least: int, times: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found, collapsed = [], []
            for text in batch["text"]:
                words = (text.as_py() or "").encode().split()  # ASCII white space
                runs = find_runs(words, least, times)
                found.append([dict(zip(("start", "length", "period"), run)) for run in runs])
                collapsed.append(b" ".join(collapse(words, runs)).decode())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(found, pa.list_(RUN)), pa.array(collapsed, pa.string())],
                ["doc_id", "runs", "collapsed"])
    return find


def periodic_runs(docs: DataFrame, least: int = 6, times: int = 4) -> DataFrame:
    """doc_id, every run of the whole text (by start, then period) and the collapsed text."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _finder(least, times), "doc_id long, runs array<struct<start: long, length: long, "
        "period: long>>, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the documents repeats a part of itself to its end.

    By the document's hash h and g = h // 10, if h ends in 0: from word a = g % n on, the text
    goes round in p = 1 + (n - a) // (3 + g % 8) words.  A null doc_id leaves the text as it is.
    """
    draw = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    words, g = F.regexp_extract_all("text", F.lit(WORDS)), F.floor(draw / 10)
    n = F.size("_words").cast("long")
    a = F.col("_g") % n
    rows = docs.select(F.col("doc_id").cast("long"), "text", draw.alias("_h"), g.alias("_g"))
    chosen = F.when((F.col("_h") % 10 == 0) & F.col("text").isNotNull(), words)
    rows = rows.withColumn("_words", chosen)
    rows = rows.withColumn("_a", F.when(n > 0, a))
    p = 1 + F.floor((n - F.col("_a")) / (3 + F.col("_g") % 8))
    rows = rows.withColumn("_p", p)

    def word(place: Column) -> Column:
        at = F.when(place < F.col("_a"), place).otherwise(
            F.col("_a") + (place - F.col("_a")) % F.col("_p"))
        return F.get("_words", at.cast("int"))

    text = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), word), " ")
    return rows.select("doc_id", F.when(F.col("_p").isNotNull(), text).otherwise(
        F.col("text")).alias("text"))


def digest_runs(docs: DataFrame) -> DataFrame:
    """The runs of planted documents: their number, the longest in periods, and digests."""
    one = F.concat_ws("", F.array_join(F.transform("runs", lambda run: F.concat_ws(
        ",", *[run[name].cast("string") for name in ("start", "length", "period")])), "\n"),
        F.when(F.size("runs") > 0, F.lit("\n")))
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    best = F.reduce("runs", none, lambda best, run: F.when(
        best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]),
        run).otherwise(best))
    rows = periodic_runs(planted(docs)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(one, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")
