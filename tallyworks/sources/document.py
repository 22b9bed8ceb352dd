"""Records of a JSON document that is too large for one task.

A document is ``{"name": [{...}, {...}], "other": [...], ...}``: lists of flat objects, beside
scalars.  Spark cuts its file into blocks of bytes and these into pieces that end with a closing
brace, wherever that stands.  A first pass tells, for each block, what it would leave behind if it
began outside a string and if it began inside one: whether it ends inside a string, which list
it ends in, and the text up to its first record border.  These few facts, one row a block, are
put together in file order, which settles how each block begins.  A second pass gives every
block's records; the last one is completed by the text that the next block begins with.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

QUOTES = re.compile(r'\\.|"', re.S)
OUTSIDE = re.compile(r'(?:[^"{]++|"(?:[^"\\]++|\\.)*+")*+', re.S)
LIST = re.compile(r'"((?:[^"\\]|\\.)*+)"\s*:\s*\[')
FACTS = "path string, start long, ends0 int, ends1 int, part0 string, part1 string, " \
        "head string, closed boolean, rest0 string, rest1 string"
FACT_ARROW = pa.schema([
    ("path", pa.string()), ("start", pa.int64()), ("ends0", pa.int32()), ("ends1", pa.int32()),
    ("part0", pa.string()), ("part1", pa.string()), ("head", pa.string()), ("closed", pa.bool_()),
    ("rest0", pa.string()), ("rest1", pa.string())])
RECORDS = pa.schema([("part", pa.string()), ("record", pa.string())])


def odd_quotes(text: str) -> bool:
    """Whether ``text`` changes from outside a string to inside or back."""
    return sum(mark == '"' for mark in QUOTES.findall(text)) % 2 == 1


def border(text: str, part: str | None = None) -> tuple[int, str | None]:
    """Where the last record of ``text`` begins (or its end), and the list it is in.

    ``text`` begins outside a string, in list ``part``, and lacks the brace that closes the
    record.  An object before any list is the document itself.
    """
    at, start = 0, len(text)
    while True:
        end = OUTSIDE.match(text, at).end()
        if end >= len(text):
            return start, part
        for found in LIST.finditer(text, at, end):
            part = found[1]
        start, at = end if part is not None else start, end + 1


class Begin(NamedTuple):
    """How a block begins, and the text that completes its last piece."""

    inside: bool
    part: str | None
    tail: str


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[str]]]:
    """The pieces of each block, in order; rows come block by block."""
    def rows():
        for batch in batches:
            yield from zip(batch["path"].to_pylist(), batch["start"].to_pylist(),
                           batch["value"].to_pylist())

    key, pieces = None, []
    for path, start, value in rows():
        if (path, start) != key and key is not None:
            yield key, pieces
            pieces = []
        key = path, start
        pieces.append(value)
    if key is not None:
        yield key, pieces


def _whole(pieces: list[str], inside: bool) -> Iterator[tuple[str, bool]]:
    """Pieces joined where a brace stands in a string, and whether each is closed."""
    held, odd = [], inside
    for piece in pieces:
        held.append(piece)
        if odd_quotes(piece):
            odd = not odd
        if not odd:
            yield "}".join(held), True
            held = []
    if held:
        yield "}".join(held), False


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (path, start), pieces in _blocks(batches):
        row = {"path": path, "start": start}
        odd = sum(map(odd_quotes, pieces)) % 2
        for inside in (0, 1):
            part, texts = None, list(_whole(pieces, bool(inside)))
            if inside:
                row |= {"head": texts[0][0], "closed": texts[0][1]}
                texts = texts[1:]
            for text, closed in texts:
                if not closed:
                    row[f"rest{inside}"] = text
                elif "[" in text:
                    part = border(text)[1] or part
            row |= {f"ends{inside}": inside ^ odd, f"part{inside}": part}
        yield pa.RecordBatch.from_pylist([row], FACT_ARROW)


def settle_blocks(rows: list) -> dict[tuple[str, int], Begin]:
    """How each block begins, from the facts of all blocks of the files."""
    rows = sorted(rows, key=lambda row: (row["path"], row["start"]))
    begins: dict[tuple[str, int], Begin] = {}
    for at, row in enumerate(rows):
        if not at or rows[at - 1]["path"] != row["path"]:
            inside, part = 0, None
        tail, ends = [], row[f"ends{inside}"]
        for later in rows[at + 1:]:
            if not ends or later["path"] != row["path"]:
                break
            tail.append(later["head"])
            ends = not later["closed"]
        if ends:
            raise ValueError(f"{row['path']} ends inside a string")
        tail = "}".join(["", *tail])
        begins[row["path"], row["start"]] = Begin(bool(inside), part, tail)
        part = row[f"part{inside}"] or part
        if row[f"rest{inside}"] is not None:
            part = border(row[f"rest{inside}"] + tail)[1] or part
        inside = row[f"ends{inside}"]
    return begins


def _records(begins: dict[tuple[str, int], Begin]):
    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, pieces in _blocks(batches):
            begin, found = begins[key], []
            texts = list(_whole(pieces, begin.inside))
            if begin.inside:
                texts = texts[1:]
            part = begin.part
            for text, closed in texts:
                if not closed:
                    text += begin.tail
                start, part = border(text, part)
                if start < len(text):
                    found.append({"part": part, "record": text[start:] + "}"})
            for at in range(0, len(found), 10_000):
                yield pa.RecordBatch.from_pylist(found[at:at + 10_000], RECORDS)
    return records


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(part, record) of every object in the lists of the documents under ``path``."""
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"), "value")
    begins = settle_blocks([row.asDict() for row in pieces.mapInArrow(_facts, FACTS).collect()])
    return pieces.mapInArrow(_records(begins), "part string, record string")
