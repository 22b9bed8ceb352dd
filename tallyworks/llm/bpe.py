"""BPE encoding and decoding with a lexicon of the corpus's frequent words.

The words of all documents are counted; the most frequent are merged once, compiled into
a transducer (lexicon.py), and given to every task as a file.  A task looks a word up
there; a word that is not in it is cut into pieces and merged by rank, exactly.  The new words
of a slice of texts are looked up and merged together, by arrays.  What a task has looked up
last it keeps, up to a bound in bytes.

The tokenizer file gives vocabulary, merges and special tokens; its path is a parameter.
Text is normalised (NFC, lower case), cut at white space and by the pattern below, and
written in byte symbols with an end-of-word mark, as the file's own description demands.

Defined results: null text counts as empty and has no ids; special tokens written out in a
text are their ids; rows repeat as they come; an empty table gives no rows.  Only doc_id
and text are read.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
import uuid
from array import array
from collections.abc import Callable, Iterable, Iterator
from heapq import heapify, heappop, heappush
from sys import getsizeof

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.lexicon import Lexicon, compile_lexicon
from tallyworks.llm.shingles import give_back, slices
from tallyworks.llm.warc import file_system
from tallyworks.llm.workers import kept
from tallyworks.sources.shared import new_folder, settle

# The pattern of the tokenizer file and its mark for the end of a word.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
END = "</w>"
SEPARATORS = "\x1c\x1d\x1e\x1f"  # white space to Python, not to the pattern
SPACES = "[ \\t\\n\\x0B\\f\\r]+"  # white space to every one
LONG = 100
TOGETHER = 1 << 20  # bytes of text whose chunks are looked up together
BLOCK = 20_000  # chunks found and remembered at a time
MEMORY = 32 << 20  # bytes a worker remembers in one filling; the filling before stays too
ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                     ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def byte_symbols() -> dict[int, str]:
    """A printable character for each byte: itself, or the next free one from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [byte for byte in range(256) if byte not in plain]
    return {byte: chr(byte) for byte in plain} | {
        byte: chr(256 + place) for place, byte in enumerate(others)}


def lowered(text: str) -> str:
    """Lower case character by character, without the rule for a final sigma."""
    return text.replace("Σ", "σ").lower()


def chunks(text: str) -> list[str]:
    """Normalised text between white space."""
    text = lowered(unicodedata.normalize("NFC", text))
    apart = any(mark in text for mark in SEPARATORS)
    return regex.findall(r"\S+", text) if apart else text.split()


class Tokenizer:
    """Vocabulary and merges of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        self.vocabulary = whole["model"]["vocab"]
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(whole["model"]["merges"])}
        self.special = {token["content"]: token["id"] for token in whole["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.symbols = byte_symbols()
        tokens = {**self.vocabulary, **self.special}
        self.tokens = [""] * (max(tokens.values()) + 1)
        for token, place in tokens.items():
            self.tokens[place] = token
        self.width = len(self.tokens) + 1
        number = self.vocabulary.get
        self.inner, self.last = (
            np.array([number(self.symbols[byte] + end, -1) for byte in range(256)])
            for end in ("", END))
        pairs = sorted((self.vocabulary[left] * self.width + self.vocabulary[right], rank,
                        self.vocabulary[left + right]) for (left, right), rank in self.ranks.items())
        self.pairs, self.order, self.joined = np.array([*pairs, (1 << 62, 0, 0)]).T.copy()

    def merge(self, piece: str) -> list[int]:
        """Ids of one piece: the adjacent pair of lowest rank is joined, again and again."""
        rank, none = self.ranks.get, len(self.ranks)
        parts = [self.symbols[byte] for byte in piece.encode()]
        parts[-1] += END
        if len(parts) >= LONG:
            return [self.vocabulary[part] for part in self._merge_long(parts)]
        pairs = [rank(pair, none) for pair in zip(parts, parts[1:])]
        while pairs and (best := min(pairs)) < none:
            at = pairs.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = rank((parts[at - 1], parts[at]), none)
            if at < len(pairs):
                pairs[at] = rank((parts[at], parts[at + 1]), none)
        return [self.vocabulary[part] for part in parts]

    def _merge_long(self, parts: list[str | None]) -> list[str]:
        """The same in n log n: a heap of pairs by rank and place, parts in a linked list."""
        rank, size = self.ranks.get, len(parts)
        after, before = array("q", range(1, size + 1)), array("q", range(-1, size - 1))
        heap = [found * size + at for at, pair in enumerate(zip(parts, parts[1:]))
                if (found := rank(pair)) is not None]
        heapify(heap)
        while heap:
            least, at = divmod(heappop(heap), size)
            other = after[at]
            if other == size or rank((parts[at], parts[other])) != least:
                continue  # one of the two has been joined to another part since
            parts[at], parts[other] = parts[at] + parts[other], None
            after[at] = after[other]
            if after[at] < size:
                before[after[at]] = at
            for left in (before[at], at):
                if left >= 0 and after[left] < size:
                    found = rank((parts[left], parts[after[left]]))
                    if found is not None:
                        heappush(heap, found * size + left)
        return [part for part in parts if part is not None]

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of many pieces: every round joins, in each, the first pair of lowest rank."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends, data = np.cumsum(sizes), np.frombuffer(b"".join(pieces), np.uint8)
        parts = self.inner[data]
        parts[ends - 1] = self.last[data[ends - 1]]
        if parts.min(initial=0) < 0:
            raise KeyError("a byte is not in the vocabulary")
        found, left, none = [b""] * len(pieces), np.arange(len(pieces)), len(self.ranks)
        while len(left):
            ends = np.cumsum(sizes)
            pair = np.append(parts[:-1] * self.width + parts[1:], -1)
            pair[ends - 1] = -1
            place = np.searchsorted(self.pairs, pair)
            rank = np.where(self.pairs[place] == pair, self.order[place], none)
            best = np.minimum.reduceat(rank << 32 | np.arange(len(parts)), ends - sizes)
            joins = best >> 32 < none
            done, stay = ~joins, np.repeat(joins, sizes)
            ids, at = parts[~stay].astype(np.uint32).tobytes(), 0
            for own, end in zip(left[done].tolist(), (4 * np.cumsum(sizes[done])).tolist()):
                found[own] = ids[at:end]
                at = end
            first = best[joins] & (1 << 32) - 1
            parts[first] = self.joined[place[first]]
            stay[first + 1] = False
            parts, sizes, left = parts[stay], sizes[joins] - 1, left[joins]
        return found

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))


class Memory(dict):
    """Packed ids by text, as ``find`` gives them, up to a number of bytes.

    When it is full it starts anew, and takes over from the last filling what is asked again.
    """

    def __init__(self, find: Callable[[str], bytes], most: int = MEMORY):
        super().__init__()
        self.find, self.most, self.old, self.size = find, most, {}, 0

    def __missing__(self, text: str) -> bytes:
        ids = self.old.get(text)
        if ids is None:
            ids = self.find(text)
        if len(text) < LONG:
            self.keep([text], [ids])
        return ids

    def keep(self, texts: list[str], ids: list[bytes]) -> None:
        if self.size >= self.most:
            self.turn()
        self.update(zip(texts, ids))
        self.size += sum(map(getsizeof, texts)) + sum(map(getsizeof, ids))
        self.size += 100 * len(texts)  # their places in the table

    def turn(self) -> None:
        self.old, self.size = dict(self), 0
        self.clear()

    def renew(self, texts: Iterable[str]) -> list[str]:
        """Take those of the last filling over; those under LONG characters in neither.

        Starts anew a little before it is full, rather than in the midst of the texts.
        """
        if self.size >= self.most * 3 // 4:
            self.turn()
        new = [text for text in texts if text not in self]
        again = [text for text in new if text in self.old]
        new = [text for text in new if text not in self.old and len(text) < LONG]
        for block in blocks(again):
            self.keep(block, [self.old.get(text) or self[text] for text in block])
        return new


def blocks(texts: list[str]) -> Iterator[list[str]]:
    return (texts[at:at + BLOCK] for at in range(0, len(texts), BLOCK))


def packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class Spelling:
    """The bytes of ids one after the other, taken from an Arrow table of them."""

    def __init__(self, texts: Iterable[bytes]):
        self.texts = pa.array(texts, pa.large_binary())

    def taken(self, ids: np.ndarray) -> tuple[np.ndarray, pa.Buffer]:
        """Where each begins and the last ends, and all of them."""
        if not len(ids):
            return np.zeros(1, np.int64), pa.py_buffer(b"")
        _, places, data = self.texts.take(pa.array(ids)).buffers()
        places = np.frombuffer(places, np.int64)[:len(ids) + 1]
        return places, data.slice(0, int(places[-1]))

    def __call__(self, ids: np.ndarray) -> pa.Buffer:
        return self.taken(ids)[1]


class Encoder:
    """Encodes whole texts."""

    def __init__(self, tokenizer: Tokenizer, lexicon: Lexicon):
        self.tokenizer, self.lexicon = tokenizer, lexicon
        self.chunks = Memory(self._chunk)
        self.special = {token: packed([i]) for token, i in tokenizer.special.items()}

    def _piece(self, piece: str) -> bytes:
        ids = self.lexicon.get(piece.encode())
        return packed(self.tokenizer.merge(piece)) if ids is None else ids

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():
            return self._piece(chunk)
        found = PIECES.findall(chunk)
        if len(found) == 1:
            return self._piece(found[0])
        return b"".join(map(self.chunks.__getitem__, found))  # a piece is a chunk of its own

    def _found(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of pieces under LONG characters, looked up and merged together."""
        data = [piece.encode() for piece in pieces]
        found = self.lexicon.get_all(data)
        new = [at for at, ids in enumerate(found) if ids is None and len(data[at]) < LONG]
        for at, ids in zip(new, self.tokenizer.merge_all([data[at] for at in new])):
            found[at] = ids
        return {piece: packed(self.tokenizer.merge(piece)) if ids is None else ids
                for piece, ids in zip(pieces, found)}

    def learn(self, texts: Iterable[str]) -> None:
        """Remember chunks that are not yet, those of a block found together."""
        for block in blocks(self.chunks.renew(texts)):
            plain = [chunk for chunk in block if chunk.isascii() and chunk.isalpha()]
            other = [chunk for chunk in block if not (chunk.isascii() and chunk.isalpha())]
            cut = list(map(PIECES.findall, other))
            pieces = list(set(plain).union(*cut))
            ids = dict(zip(pieces, map(self.chunks.get, pieces)))
            ids |= self._found([piece for piece, own in ids.items() if own is None])
            self.chunks.keep(plain + other, [*map(ids.__getitem__, plain), *(
                b"".join(map(ids.__getitem__, own)) for own in cut)])

    def _parts(self, text: str) -> Iterator[bytes | list[str]]:
        """Ids of special tokens, and the chunks between them; long ones are given in pieces."""
        parts = [text] if not any(map(text.__contains__, self.special)) else (
            self.tokenizer.cut.split(text))
        for part in parts:
            if part in self.special:
                yield self.special[part]
                continue
            own = chunks(part)
            if max(map(len, own), default=0) >= LONG:
                own = [piece for chunk in own for piece in
                       (PIECES.findall(chunk) if len(chunk) >= LONG else [chunk])]
            yield own

    def packed(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, four bytes each."""
        cut = [list(self._parts(text)) for text in texts]
        self.learn(set().union(*(part for parts in cut for part in parts
                                 if not isinstance(part, bytes))))
        for parts in cut:
            yield b"".join(part if isinstance(part, bytes)
                           else b"".join(map(self.chunks.__getitem__, part)) for part in parts)

    def encode(self, text: str) -> list[int]:
        return memoryview(next(self.packed([text]))).cast("I").tolist()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of chunks, each as often as its chunk is there."""
    for batch in batches:
        words, times = [], []
        for text, n in zip(batch["chunk"].to_pylist(), batch["n"].to_pylist()):
            for chunk in chunks(text):
                found = [piece for piece in PIECES.findall(chunk) if len(piece) < LONG]
                words += found
                times += [n] * len(found)
        yield pa.RecordBatch.from_pydict({
            "word": pa.array(words, pa.string()), "n": pa.array(times, pa.int64())})


def word_counts(docs: DataFrame) -> DataFrame:
    """How often each word under LONG characters is in all documents.

    Chunks are counted first, so that each is normalised and cut once.  Longer words are no
    entries of a lexicon; they are merged where they stand.
    """
    chunked = (docs.select(F.explode(F.split("text", SPACES)).alias("chunk"))
               .groupBy("chunk").agg(F.count("*").alias("n")))
    return (chunked.mapInArrow(_cut, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def frequent_words(docs: DataFrame, words: int) -> list[str]:
    """At most ``words`` of the most frequent words of all documents.

    Which words are chosen steers speed alone, as others are merged exactly.  A histogram of the
    counts, in eighths of powers of two, tells from where on they fit, so that no more than that
    many words come to the driver.
    """
    counted = settle(word_counts(docs), "words")
    step = F.floor(F.log2("n") * 8)
    left, least = words, None
    for row in sorted(counted.groupBy(step.alias("step")).count().collect(), reverse=True):
        left -= row["count"]
        if left < 0:
            break
        least = row.step
    if least is None:
        return []
    return [row.word for row in counted.filter(step >= least).collect()]


def _ready(tokenizer_path: str, lexicon_name: str) -> Encoder:
    """The encoder of a worker, with what it remembers."""
    return Encoder(Tokenizer(tokenizer_path), Lexicon(SparkFiles.get(lexicon_name)))


def _digest(spelled: pa.Buffer) -> str:
    """Of what is spelled without the space after the last id."""
    return hashlib.sha256(spelled.slice(0, max(0, spelled.size - 1))).hexdigest()


def _encoder(tokenizer_path: str, lexicon_name: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(_ready, tokenizer_path, lexicon_name)
        tokens = encoder.tokenizer.tokens
        decimal = Spelling(f"{i} ".encode() for i in range(len(tokens)))
        decoded = Spelling(f"{token} ".encode() for token in tokens)
        for batch in slices(batches, TOGETHER):
            rows, texts = [], [text or "" for text in batch["text"].to_pylist()]
            for doc_id, ids in zip(batch["doc_id"], encoder.packed(texts)):
                ids = np.frombuffer(ids, np.uint32)
                rows.append((doc_id.as_py(), len(ids), _digest(decimal(ids)),
                             _digest(decoded(ids))))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(ENCODED.names, row)) for row in rows], ENCODED)
    return encode


def ship_lexicon(spark: SparkSession, tokenizer: Tokenizer, words: list[str]) -> str:
    """Compile the words, write the file to the shared folder, hand it to every task."""
    compiled = compile_lexicon((word.encode(), tokenizer.merge(word)) for word in words)
    name = f"{uuid.uuid4().hex}.lexicon"
    path = f"{new_folder(spark, 'lexicon')}/{name}"
    store, place = file_system(path)
    with store.open_output_stream(place) as out:
        out.write(compiled)
    spark.sparkContext.addFile(path)
    give_back()  # what compiling took of the driver
    return name


def encode_documents(spark: SparkSession, docs: DataFrame, tokenizer_path: str,
                     words: int = 200_000) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text of every document.

    The lexicon holds at most ``words`` words, the most frequent of all documents.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    name = ship_lexicon(spark, Tokenizer(tokenizer_path), frequent_words(docs, words))
    return docs.mapInArrow(
        _encoder(tokenizer_path, name),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
