"""Words and word shingles of whole texts as 64-bit hashes, by numpy over their bytes."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
ONE = np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64 over all of them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batches: Iterator[pa.RecordBatch], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text at a time, one row at least.

    After the last one, what the task has freed goes back to the machine, as its process stays
    for later tasks.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(sizes, dtype=np.int64), 0
        while at < len(ends):
            start = ends[at] - sizes[at]
            upto = max(at + 1, int(np.searchsorted(ends, start + most)))
            yield batch.slice(at, upto - at)
            at = upto
    give_back()


def give_back() -> None:
    """Hand freed memory of Arrow and of the C library back to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Powers:
    """Powers of an odd base modulo 2^64, and of its inverse, as far as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < size:
            inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
            ones = np.ones(max(size, CHUNK + 1), np.uint64)
            ones[1:] = BASE
            self.up = np.cumprod(ones)
            ones[1:] = inverse
            self.down = np.cumprod(ones)
        return self.up[:size], self.down[:size]


POWERS = Powers()


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased."""
    apart = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate([[True], apart, [True]]).astype(np.int8))
    starts, ends = np.nonzero(edge == -1)[0], np.nonzero(edge == 1)[0]
    letters = data.astype(np.uint64)
    letters[(data >= 65) & (data <= 90)] += np.uint64(32)
    up, down = POWERS.to(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((letters + ONE) * up[:-1])])
    return starts, mix((sums[ends] - sums[starts]) * down[starts])


def shingle_sets(texts: list[str | None], length: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in order.

    A text of fewer words has one shingle, of all its words; one without words has none.
    """
    at = 0
    while at < len(texts):
        part, size = [], 0
        while at < len(texts) and (not part or size < CHUNK):
            part.append((texts[at] or "").encode())
            size += len(part[-1])
            at += 1
        firsts = np.cumsum([0, *(len(text) + 1 for text in part)])
        starts, hashes = words(np.frombuffer(b" ".join(part) + b" ", np.uint8))
        bounds = np.searchsorted(starts, firsts)
        whole = np.zeros(max(len(hashes) - length + 1, 0), np.uint64)
        for j in range(length):
            whole += hashes[j:len(whole) + j] * POWERS.to(length + 2)[0][j + 1]
        whole = mix(whole)
        for first, last in zip(bounds[:-1], bounds[1:]):
            if last - first >= length:
                yield np.unique(whole[first:last - length + 1])
            elif last > first:
                few = hashes[first:last]
                yield mix((few * POWERS.to(length + 2)[0][1:len(few) + 1]).sum(
                    keepdims=True, dtype=np.uint64) + np.uint64(len(few)))
            else:
                yield np.zeros(0, np.uint64)
