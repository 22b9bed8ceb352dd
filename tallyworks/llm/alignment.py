"""Alignment of two tokenizers' tokens over the same bytes, and how common their links are.

Both tokenizers cut the bytes of a text.  One side's cumulative byte ends go into a table from
end to token index, which is asked for the other's; the ends both hold, sorted, slice both id
lists into groups, and within a group every pair of tokens whose byte ranges overlap is a link.

How many documents hold an id pair linked is counted over the corpus.  Documents are worked
through in blocks of bounded bytes, and what is shuffled are the distinct pairs of a block, not
those of a document: they are added up, compared with the best of their first id, and return to
their block, where each document's links look themselves up.

A text that is null or empty, or whose tokens of either side do not give back its bytes
with one space before them, has no tokens.  Defined results for the rest: repeated rows are
counted as documents of their own; a null doc_id is carried along; an empty table gives no
rows; strings of special tokens inside a text are plain text.  Only doc_id and text are read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.bpe import Spelling, byte_symbols
from tallyworks.llm.shingles import slices
from tallyworks.sources.shared import settle

BLOCK = 16 << 20  # bytes of text whose distinct pairs are shuffled together
COUNTS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string"
KEPT = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string()),
    ("held", pa.binary()), ("times", pa.binary()),
    ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64()))])
PACK = pa.Codec("zstd")


def byte_level(path: str) -> tuple[tiktoken.Encoding, list[bytes]]:
    """Encoder and token bytes of a byte-level BPE file, whose ids are ranks."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    byte = {symbol: number for number, symbol in byte_symbols().items()}
    special = {token["content"] for token in whole["added_tokens"]}
    ranks = {bytes(map(byte.__getitem__, token)): rank
             for token, rank in whole["model"]["vocab"].items() if token not in special}
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tiktoken.Encoding("byte_level", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=ranks, special_tokens={}), tokens


def pieces(path: str) -> tuple[sentencepiece.SentencePieceProcessor, list[bytes]]:
    """Encoder and token bytes of a sentence-piece model."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        tokens.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i)
                      else piece.replace("▁", " ").encode())
    return model, tokens


class Side:
    """What is known of one tokenizer's ids: their bytes, and how groups are written."""

    def __init__(self, tokens: list[bytes], closing: str):
        self.spell = Spelling(tokens)
        self.lengths = np.array(list(map(len, tokens)), np.int64)
        ids = range(len(tokens))
        self.marked = [f"{i},".encode() for i in ids] + [f"{i}{closing}".encode() for i in ids]

    def ends(self, ids: np.ndarray) -> np.ndarray:
        """Cumulative byte ends."""
        return np.cumsum(self.lengths[ids])


@lru_cache(maxsize=1)
def _marks(left: Side, right: Side) -> Spelling:
    """Ids of both sides with the mark that follows: left within and at the end, then right."""
    return Spelling(left.marked + right.marked)


@dataclass
class Aligned:
    """Groups of texts, by the tokens of both sides up to their ends, and their links."""

    a: np.ndarray
    b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray

    def written(self, left: Side, right: Side) -> str:
        """Groups as ``a1,a2|b1;a3|b2,b3``."""
        return self.marked(left, right)[1].to_pybytes()[:-1].decode()

    def marked(self, left: Side, right: Side) -> tuple[np.ndarray, pa.Buffer]:
        """Every token with the mark that follows it: where each begins, and all of them."""
        sizes_a, sizes_b = np.diff(self.ends_a, prepend=0), np.diff(self.ends_b, prepend=0)
        marks = np.empty(len(self.a) + len(self.b), np.int64)
        place_a = np.arange(len(self.a)) + np.repeat(self.ends_b - sizes_b, sizes_a)
        place_b = np.arange(len(self.b)) + np.repeat(self.ends_a, sizes_b)
        first = 0
        for place, ids, ends, side in ((place_a, self.a, self.ends_a, left),
                                       (place_b, self.b, self.ends_b, right)):
            marks[place] = ids + first
            marks[place[ends - 1]] += len(side.lengths)
            first += len(side.marked)
        return _marks(left, right).taken(marks)


def align(a: Sequence[int], b: Sequence[int], left: Side, right: Side) -> Aligned:
    """Groups and links of two id lists over the same bytes.

    The other side's table is asked for this side's ends, which come sorted: what it holds are
    the common ends, with the places of both.  Two tokens that overlap do so in one stretch, which
    ends where the first of them ends: every end of either side is one link, with the token of
    the other side that holds the byte before it.  Links come by the ends of the first side, then by
    those that only the second has.
    """
    a, b = np.asarray(a, np.int64), np.asarray(b, np.int64)
    all_a, all_b = left.ends(a), right.ends(b)
    at_b = np.zeros(all_b[-1] + 1 if len(b) else 1, np.int32)
    at_b[all_b] = np.arange(1, len(b) + 1)
    found = at_b[all_a]
    ends_a = np.nonzero(found)[0] + 1
    ends_b = found[ends_a - 1].astype(np.int64)
    alone = np.ones(len(b), bool)  # ends that the other side does not have
    alone[ends_b - 1] = False
    held_a, held_b = np.searchsorted(all_a, all_b[alone]), np.searchsorted(all_b, all_a)
    return Aligned(a, b, ends_a, ends_b, np.concatenate([a, a[held_a]]),
                   np.concatenate([b[held_b], b[alone]]))


class Aligner:
    """Both tokenizers of a worker."""

    def __init__(self, path_a: str, path_b: str):
        self.encoder_a, tokens_a = byte_level(path_a)
        self.encoder_b, tokens_b = pieces(path_b)
        self.left, self.right = Side(tokens_a, "|"), Side(tokens_b, ";")

    def align(self, text: str | None) -> Aligned:
        return self.together([text])[0]

    def together(self, texts: list[str | None]) -> tuple[Aligned, np.ndarray, np.ndarray]:
        """The texts one after the other, and the tokens of both sides up to the end of each.

        Both sides have an end where a text ends, so no group and no link reaches into the next.
        """
        whole, a, b = [], [], []
        for text in texts:
            whole.append((" " + text).encode() if text else b"")
            a.append(np.asarray(self.encoder_a.encode_to_numpy(
                " " + text, disallowed_special=()) if text else [], np.int64))
            b.append(np.asarray(self.encoder_b.encode(text) if text else [], np.int64))
        spelled, at = self.right.spell(np.concatenate(b)).to_pybytes(), 0
        for i, data in enumerate(whole):
            upto = at + int(self.right.lengths[b[i]].sum())
            # The byte-level side gives parts of the text in order: all of it if the lengths agree.
            if self.left.lengths[a[i]].sum() != len(data) or spelled[at:upto] != data:
                a[i] = b[i] = a[i][:0]
            at = upto
        return (align(np.concatenate(a), np.concatenate(b), self.left, self.right),
                np.cumsum(list(map(len, a))), np.cumsum(list(map(len, b))))

    def written(self, aligned: Aligned) -> str:
        return aligned.written(self.left, self.right)

    def rows(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, str, np.ndarray,
                                                              np.ndarray]]:
        """Of every text the tokens of both sides, groups, groups written, and its distinct links:
        as one number each, sorted, and how often each is there."""
        whole, to_a, to_b = self.together(texts)
        n_a, n_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        n_groups = np.diff(np.searchsorted(whole.ends_a, to_a, "right"), prepend=0)
        places, marks = whole.marked(self.left, self.right)
        marks, ends = marks.to_pybytes().decode(), places[to_a + to_b].tolist()
        pairs = whole.link_a * len(self.right.lengths) + whole.link_b
        by_a, by_b = np.split(pairs, [len(whole.a)])  # links of ends of A, and of ends B alone has
        by_a = np.split(by_a, to_a)
        by_b = np.split(by_b, np.cumsum(n_b - n_groups))
        for i, (start, end) in enumerate(zip([0, *ends], ends)):
            yield (int(n_a[i]), int(n_b[i]), int(n_groups[i]), marks[start:max(start, end - 1)],
                   *np.unique(np.concatenate([by_a[i], by_b[i]]), return_counts=True))


@lru_cache(maxsize=1)
def _ready(path_a: str, path_b: str) -> Aligner:
    """The tokenizers of a worker, for all the tasks it runs."""
    return Aligner(path_a, path_b)


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers of rising or small size, compressed: width, length, then the rest."""
    kind = np.uint32 if not len(numbers) or numbers.max() < 1 << 32 else np.uint64
    data = numbers.astype(kind).tobytes()
    head = np.array([kind().itemsize, len(data)], np.int64).tobytes()
    return head + PACK.compress(data, asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    width, size = np.frombuffer(data, np.int64, 2).tolist()
    whole = PACK.decompress(data[16:], decompressed_size=size, asbytes=True)
    return np.frombuffer(whole, np.uint32 if width == 4 else np.uint64).astype(np.int64)


def _aligner(path_a: str, path_b: str, most: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _ready(path_a, path_b)
        first = TaskContext.get().partitionId() << 32
        block, size, seen = first, 0, []

        def closed() -> pa.RecordBatch:
            """The distinct pairs of the block and the documents that hold each."""
            pairs, docs = np.unique(np.concatenate(seen), return_counts=True) if seen else ([], [])
            row = {"block": block, "pairs": pairs, "docs": docs}
            return pa.RecordBatch.from_pylist([row], KEPT)

        for batch in slices(batches, most // 8):
            made = []
            texts = batch["text"].to_pylist()
            for doc_id, row in zip(batch["doc_id"].to_pylist(), aligner.rows(texts)):
                n_a, n_b, n_groups, groups, pairs, times = row
                if len(pairs):
                    seen.append(pairs)
                made.append({
                    "block": block, "doc_id": doc_id, "n_a": n_a, "n_b": n_b,
                    "n_groups": n_groups, "n_links": n_a + n_b - n_groups, "groups": groups,
                    "held": packed(np.diff(pairs, prepend=0)), "times": packed(times)})
            yield pa.RecordBatch.from_pylist(made, KEPT)
            size += batch["text"].nbytes
            if size >= most:
                yield closed()
                block, size, seen = block + 1, 0, []
        if seen:
            yield closed()
    return rows


def _rated(docs: pa.Table, links: pa.Table) -> pa.Table:
    """The documents of a block with what the corpus says of their links."""
    pairs = links["pair"].to_numpy()
    order = np.argsort(pairs)
    pairs, counts = pairs[order], links["count"].to_numpy()[order]
    best = links["best"].to_numpy()[order]
    n_best, count_sum = [], []
    for held, times in zip(docs["held"], docs["times"]):
        at = np.searchsorted(pairs, np.cumsum(unpacked(held.as_py())))
        often = unpacked(times.as_py())
        n_best.append(int(often[best[at]].sum()))
        count_sum.append(int((often * counts[at]).sum()))
    return docs.select([0, 1, 2, 3, 4, 5]).append_column(
        "n_best", pa.array(n_best, pa.int64())).append_column(
        "count_sum", pa.array(count_sum, pa.int64()))


def alignments(docs: DataFrame, path_a: str, path_b: str, block: int = BLOCK) -> DataFrame:
    """Rows of documents (block, counts, groups, held links) and of blocks (pairs, docs)."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _aligner(path_a, path_b, block),
        f"block long, {COUNTS}, held binary, times binary, pairs array<long>, docs array<long>")


def align_documents(docs: DataFrame, path_a: str, path_b: str, groups: Column | str = "groups",
                    block: int = BLOCK) -> DataFrame:
    """Tokens, groups and links of every document, and how common its links are.

    ``groups`` is what is kept of the written groups, themselves by default.  An id pair's
    count is the number of documents that hold it linked; ``n_best`` links have the highest
    count of their first id, and ``count_sum`` adds the counts of all links.  ``block`` is in
    bytes of text and changes no result.
    """
    width = len(pieces(path_b)[1])
    kept = settle(alignments(docs, path_a, path_b, block).withColumn(
        "groups", F.col(groups) if isinstance(groups, str) else groups), "alignment")
    held = (kept.filter(F.col("pairs").isNotNull())
            .select("block", F.explode(F.arrays_zip("pairs", "docs")).alias("link"))
            .select("block", F.col("link.pairs").alias("pair"), F.col("link.docs").alias("docs")))
    # An id has at most as many pairs as the other vocabulary has ids.
    same = Window.partitionBy(F.floor(F.col("pair") / width))
    counts = held.groupBy("pair").agg(F.sum("docs").alias("count")).select(
        "pair", "count", (F.col("count") == F.max("count").over(same)).alias("best"))
    links = held.select(F.col("block").alias("at"), "pair").join(counts, "pair")
    rows = kept.filter(F.col("held").isNotNull()).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "held", "times", "block")
    return rows.groupBy("block").cogroup(links.groupBy("at")).applyInArrow(
        _rated, f"{COUNTS}, n_best long, count_sum long")


def digest_alignments(docs: DataFrame, path_a: str, path_b: str,
                      block: int = BLOCK) -> DataFrame:
    """The same with a digest in place of the written groups; none without tokens."""
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return align_documents(docs, path_a, path_b, digest, block).withColumnRenamed(
        "groups", "groups_sha256")
