"""Token counts by longest match, in one pass over the bytes of a text.

A trie holds the vocabulary.  A state is what has been read since the last token that is
certain; where no edge goes on, its failure link leads to the state of what remains once the
tokens that are then certain are popped, and their number is kept with the state.  Every
failure pops a token, so a text takes time in proportion to its length, whatever it holds.

A word, ``[^\\x20\\x09-\\x0D]+``, is read with one space before it, as the vocabulary writes the
beginning of words; the longest token that fits is taken, again and again.  No token reaches
over white space: those of the vocabulary that hold any behind their first byte are left out.

Defined results: null text counts as empty and has no tokens; special tokens of the
vocabulary are tokens like others; rows repeat as they come; an empty table gives no rows; a
vocabulary that lacks a byte raises.  Only doc_id and text are read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.bpe import byte_symbols
from tallyworks.llm.shingles import slices

WHITE = re.compile(rb"[\x20\x09-\x0D]+")


def read_vocabulary(path: str) -> list[bytes]:
    """The tokens of a tokenizer file that writes them in byte symbols."""
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file)["model"]["vocab"]
    byte = {symbol: number for number, symbol in byte_symbols().items()}
    written = (bytes(map(byte.__getitem__, token)) for token in tokens)
    return [token for token in written if not WHITE.search(token, 1)]


class LongestMatch:
    """The automaton of a vocabulary; states are numbered in steps of 256, the start is 0."""

    def __init__(self, tokens: Iterable[bytes]):
        self.step: dict[int, int] = {}
        depth, ends = [0], set()
        for token in tokens:
            state = 0
            for place, byte in enumerate(token, 1):
                ahead = self.step.get(state + byte)
                if ahead is None:
                    ahead = self.step[state + byte] = len(depth) << 8
                    depth.append(place)
                state = ahead
            ends.add(state)
        if any(self.step.get(byte) not in ends for byte in range(256)):
            raise ValueError("the vocabulary lacks a byte")
        self.fail, self.popped = {0: 0}, {0: 0}
        for edge, state in sorted(self.step.items(), key=lambda x: depth[x[1] >> 8]):
            if state in ends:
                self.fail[state], self.popped[state] = 0, 1
                continue
            before, byte = edge & ~255, edge & 255
            at, count = self.fail[before], self.popped[before]
            while (ahead := self.step.get(at + byte)) is None:
                count += self.popped[at]
                at = self.fail[at]
            self.fail[state], self.popped[state] = ahead, count

    def count(self, data: bytes) -> int:
        """The number of longest matches, one after the other, that ``data`` falls into."""
        get, fail, popped = self.step.get, self.fail, self.popped
        state = count = 0
        for byte in data:
            ahead = get(state + byte)
            while ahead is None:
                count += popped[state]
                state = fail[state]
                ahead = get(state + byte)
            state = ahead
        while state:
            count += popped[state]
            state = fail[state]
        return count

    def count_text(self, text: str | None) -> int:
        return self.count(WHITE.sub(b" ", b" " + (text or "").encode()).rstrip(b" "))


@lru_cache(maxsize=1)
def _ready(path: str) -> LongestMatch:
    """The automaton of a worker, for all the tasks it runs."""
    return LongestMatch(read_vocabulary(path))


def _counter(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _ready(path)
        for batch in slices(batches):
            counts = [automaton.count_text(text.as_py()) for text in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])
    return count


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and n_tokens of every document, with the vocabulary of a tokenizer file."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _counter(path), "doc_id long, n_tokens long")
