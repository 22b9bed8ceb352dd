"""A minimal acyclic transducer from words to id sequences, in one memory-mapped file.

Words are added in byte order; states with the same edges are merged as soon as no later word
can change them, so common suffixes are stored once.  An edge carries the number of words
that sort before its branch: the sum along a path is the word's index, which points to its
ids.  The file holds plain arrays and is looked up where it lies: the labels of a state's edges
are bytes next to each other, in which the next byte is searched.
"""

from __future__ import annotations

import mmap
from array import array
from collections.abc import Iterable

import numpy as np

ARRAYS = "first target skip final starts ids".split()
HEAD = 3  # bytes at the beginning of a word whose path is remembered


def compile_lexicon(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """The automaton of distinct words with their ids."""
    entries = sorted(entries)
    known: dict[tuple, int] = {}
    states: list[tuple] = []
    counts: list[int] = []

    def settled(final: bool, edges: list[tuple[int, int]]) -> int:
        shape = (final, tuple(edges))
        state = known.get(shape)
        if state is None:
            state = known[shape] = len(states)
            states.append(shape)
            counts.append(final + sum(counts[target] for _, target in edges))
        return state

    path: list[list] = [[False, []]]  # open states along the last word: final, settled edges
    last = b""

    def close(depth: int) -> None:
        while len(path) - 1 > depth:
            final, edges = path.pop()
            path[-1][1].append((last[len(path) - 1], settled(final, edges)))

    for word, _ in entries:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        close(common)
        path += [[False, []] for _ in range(len(word) - common)]
        path[-1][0] = True
        last = word
    close(0)
    settled(*path[0])  # the start is the last state

    made, labels = {name: array("I") for name in ARRAYS}, bytearray()
    for final, edges in states:
        made["first"].append(len(labels))
        made["final"].append(final)
        before = int(final)
        for label, target in edges:
            labels.append(label)
            made["target"].append(target)
            made["skip"].append(before)
            before += counts[target]
    made["first"].append(len(labels))
    for _, ids in entries:
        made["starts"].append(len(made["ids"]))
        made["ids"].extend(ids)
    made["starts"].append(len(made["ids"]))
    sizes = array("I", [len(made[name]) for name in ARRAYS])
    return sizes.tobytes() + b"".join(made[name].tobytes() for name in ARRAYS) + labels


class Lexicon:
    """Look-up in a compiled file."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.file = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        whole = memoryview(self.file)
        at = len(ARRAYS) * 4
        for name, size in zip(ARRAYS, whole[:at].cast("I").tolist()):
            setattr(self, name, whole[at:at + 4 * size].cast("I"))
            at += 4 * size
        self.labels = at
        edges = np.diff(np.frombuffer(self.first, np.uint32))
        self.edges = (np.repeat(np.arange(len(edges)) << 8, edges)  # state and label, ascending
                      | np.frombuffer(self.file, np.uint8, offset=at))
        self.start = len(self.final) - 1
        self.heads: dict[bytes, tuple[int, int]] = {}  # those of words in the file, no others

    def _walk(self, state: int, index: int, word: bytes) -> tuple[int, int] | None:
        """The state that ``word`` leads to, and the number of words before it."""
        find, first, target, skip = self.file.find, self.first, self.target, self.skip
        labels = self.labels
        for at in range(len(word)):
            edge = find(word[at:at + 1], labels + first[state], labels + first[state + 1]) - labels
            if edge < 0:
                return None
            state = target[edge]
            index += skip[edge]
        return state, index

    def get(self, word: bytes) -> bytes | None:
        """The ids of a word as they lie in the file, four bytes each."""
        head = word[:HEAD]
        place = self.heads.get(head)
        if place is None:
            place = self._walk(self.start, 0, head)
            if place is None:
                return None
            self.heads[head] = place
        place = self._walk(*place, word[HEAD:])
        if place is None or not self.final[place[0]]:
            return None
        index = place[1]
        return self.ids[self.starts[index]:self.starts[index + 1]].tobytes()

    def get_all(self, words: list[bytes]) -> list[bytes | None]:
        """The same for many words, which go along their paths together, byte by byte."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        firsts = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(words), np.uint8)
        targets, skips = (np.frombuffer(own, np.uint32) for own in (self.target, self.skip))
        state, index = np.full(len(words), self.start), np.zeros(len(words), np.int64)
        alive = np.arange(len(words))
        for at in range(int(sizes.max(initial=0)) if len(self.edges) else 0):
            alive = alive[sizes[alive] > at]
            wanted = state[alive] << 8 | data[firsts[alive] + at]
            edge = np.minimum(np.searchsorted(self.edges, wanted), len(self.edges) - 1)
            there = self.edges[edge] == wanted
            state[alive[~there]] = -1
            alive, edge = alive[there], edge[there]
            state[alive] = targets[edge]
            index[alive] += skips[edge]
        if not len(self.edges):
            state[sizes > 0] = -1
        known = (state >= 0) & (np.frombuffer(self.final, np.uint32)[state] > 0)
        found: list[bytes | None] = [None] * len(words)
        for place, at in zip(np.flatnonzero(known).tolist(), index[known].tolist()):
            found[place] = self.ids[self.starts[at]:self.starts[at + 1]].tobytes()
        return found
