"""N-gram Jaccard join by parity sketches.

A document's set of word shingles is sketched in cells: each shingle is XORed into one cell,
so that the cells in which two sketches differ are at most the shingles in which the sets
differ.  Sets of sizes a <= b that reach the threshold differ in at most (a + b)(1 - t)/(1 + t)
shingles.  Sizes lie in bands; for each band the sketch has more cells than its sets
may differ in, so two sets that link have an equal cell (pigeonhole), and documents meet
where they have equal cells.  What meets is verified on the whole sets.

* An empty cell says nothing and is not joined; a document with so many empty cells that a
  partner could equal it in those alone is sketched again by another hash.
* Shingles that very many documents of a bounded sample hold are left out of the first sketch.
  That can only lessen the difference, so no link is lost; a document left with too many empty
  cells is sketched by its whole set as well.
* Equal sets are one class, and only its document of smallest doc_id is sketched.  Cells travel in
  packed columns, a row per batch and bucket.
* Whole texts are shuffled once, to the documents that meet any other: by a join that is never a
  broadcast, as the number of such documents grows with the corpus.  They are shuffled once more
  where the list of copies is too large for Spark to broadcast.
* Of documents that meet, texts are kept and sent to their pairs, not shingles, which take more
  room on disk.  More pairs than texts go in slices, so that at most about as much as all of the
  texts lies on disk at once.
* Members of a cell first meet its first or last; only those that are still in different
  components after that are paired off, if sizes and the distance of short bit sketches allow a
  link.

Defined results: null text or text without words has an empty set and links with nothing; a
null doc_id has no component; rows with one doc_id are one document, and link if any of their
texts does; an empty table gives no rows.  Only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.components import components
from tallyworks.llm.shingles import mix, shingle_sets, slices
from tallyworks.sources.shared import settle

PERCENT = 80
SEEN = 200_000  # sets a task remembers; a repeated row it has forgotten is sketched again
PAIRS = 100_000  # that are verified at once where there are fewer texts
PACKED = pa.schema([("bucket", pa.int64()), ("cells", pa.binary()), ("gaps", pa.binary())])
BITS = tuple(f"bits{at}" for at in range(8))
TOLD = ("n", *BITS)  # what is known of a set without its shingles


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size of each set, 128 bits that name it, and its bit sketch."""
    for batch in slices(batches):
        sets = list(shingle_sets(batch["text"].to_pylist()))
        sketches = np.stack([bit_sketch(s) for s in sets])
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch["doc_id"], "n": pa.array([len(s) for s in sets], pa.int64()),
            "name": pa.array([_name(s) for s in sets], pa.binary())} | {
            bits: sketches[:, at] for at, bits in enumerate(BITS)})


def _name(found: np.ndarray) -> bytes:
    return found.sum(dtype=np.uint64).tobytes() + np.bitwise_xor.reduce(
        mix(found + np.uint64(99))).tobytes() if len(found) else b""


def bit_sketch(found: np.ndarray) -> np.ndarray:
    """Each shingle flips one bit, so at most as many bits differ as shingles."""
    flips = np.bincount((mix(found) >> np.uint64(55)).astype(np.int64), minlength=64 * len(BITS))
    return np.packbits((flips & 1).astype(bool)).view(np.int64)


def _near(percent: int) -> Column:
    """Whether two rows, the second with ``_o`` behind its names, may link by size and bits.

    Sizes and bits are null, and tell nothing, where a doc_id stands for several texts.
    """
    small, large = F.least("n", "n_o"), F.greatest("n", "n_o")
    apart = sum((F.bit_count(F.col(bits).bitwiseXOR(F.col(f"{bits}_o"))) for bits in BITS[1:]),
                F.bit_count(F.col(BITS[0]).bitwiseXOR(F.col(f"{BITS[0]}_o"))))
    near = (small * 100 >= large * percent) & (
        apart * (100 + percent) <= (small + large) * (100 - percent))
    return F.coalesce(near, F.lit(True))


class Bands:
    """Bands of set sizes and the cells of each.

    A set may link with the sets of its own band and of the next on either side, so it is
    sketched for its own band, in which it may be the larger, and for the next.
    """

    def __init__(self, percent: int):
        self.percent = percent
        self.edges = [1]

    def of(self, size: int) -> int:
        while self.edges[-1] <= size:
            self.edges.append(self.edges[-1] * 100 // self.percent + 1)
        return np.searchsorted(self.edges, size, side="right") - 1

    def differ(self, a: int, b: int) -> int:
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def cells(self, band: int) -> int:
        while len(self.edges) < band + 2:
            self.edges.append(self.edges[-1] * 100 // self.percent + 1)
        most = self.differ(self.edges[band + 1] - 1, self.edges[band + 1] - 1)
        return most + 1 + math.ceil(0.05 * (most + 1)) if most else 0

    def allowed(self, size: int, band: int) -> int:
        """Most shingles a partner in the band's sketch may differ in."""
        return self.differ(size, min(size * 100 // self.percent, self.edges[band + 1] - 1))


def _cells(found: np.ndarray, cells: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the cells that are not empty, and what is in them."""
    cell = ((mix(found + np.uint64(seed)) >> np.uint64(32)) * np.uint64(cells)) >> np.uint64(32)
    order = np.argsort(cell, kind="stable")
    cell, inside = cell[order], found[order]
    first = np.nonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))[0] if len(cell) else []
    return cell[first], np.bitwise_xor.reduceat(inside, first) if len(cell) else inside


def cell_keys(found: np.ndarray, bands: Bands, common: np.ndarray) -> np.ndarray:
    """Keys by which a set meets the sets it may link with: its cells that are not empty.

    At most as many cells differ as shingles may, so one of two sets with more cells in use than
    that has a cell that the other has too.  A set with fewer cells in use is sketched again by
    another hash, as often as it takes; its partner either had enough, and both have the keys of
    that sketch, or goes on to the next as well.
    """
    size, keys = len(found), []
    rare = found[~np.isin(found, common, assume_unique=True)] if len(common) else found
    own = bands.of(size)
    for band in (own, own + 1):
        cells = bands.cells(band)
        if not cells:
            continue  # sets so small link only if they are equal
        for salt in count():
            part = found if salt else rare
            number, inside = _cells(part, cells, band + (salt << 16))
            where = mix(number + np.uint64(((band << 8) + salt) << 32))
            keys.append(mix(inside + where))
            if len(number) > bands.allowed(size, band):
                break
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


def _pack_cells(buckets: int, common: np.ndarray, percent: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = Bands(percent), set()
        for batch in slices(batches):
            keys, owners = [], []
            if len(seen) > SEEN:
                seen.clear()
            for doc_id, found in zip(batch["doc_id"].to_pylist(),
                                     shingle_sets(batch["text"].to_pylist())):
                name = _name(found)
                if len(found) and name not in seen:
                    seen.add(name)
                    keys.append(cell_keys(found, bands, common))
                    owners.append(np.full(len(keys[-1]), doc_id, np.int64))
            if not keys:
                continue
            key, owner = np.concatenate(keys), np.concatenate(owners)
            bucket = ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            order = np.lexsort((owner, bucket))
            key, owner, bucket = key[order].astype(np.uint32), owner[order], bucket[order]
            first = np.nonzero(np.diff(bucket, prepend=-1))[0]
            last = [*first[1:], len(bucket)]
            yield pa.RecordBatch.from_pydict({
                "bucket": bucket[first],
                "cells": [key[a:b].tobytes() for a, b in zip(first, last)],
                "gaps": [np.diff(owner[a:b], prepend=0).tobytes() for a, b in zip(first, last)]},
                schema=PACKED)
    return pack


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells with more than one document, bucket by bucket; rows come sorted by bucket.

    With each member stands the one it is held against first: the cell's first, or for that its
    last.
    """
    held: dict[int, list[tuple[bytes, bytes]]] = {}

    def met(bucket: int) -> pa.RecordBatch:
        rows = held.pop(bucket)
        key = np.concatenate([np.frombuffer(cells, np.uint32) for cells, _ in rows])
        owner = np.concatenate([np.cumsum(np.frombuffer(gaps, np.int64)) for _, gaps in rows])
        order = np.lexsort((owner, key))
        key, owner = key[order], owner[order]
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
        key, owner = key[fresh], owner[fresh]
        start = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0]
        held_by = np.diff(np.append(start, len(key)))
        x, y = owner[start], owner[start + held_by - 1]
        other = np.repeat(x, held_by)
        other[start] = y
        shared = np.repeat(held_by > 1, held_by)
        return pa.RecordBatch.from_pydict({
            "cell": (np.int64(bucket) << 32) + key[shared].astype(np.int64),
            "rep": owner[shared], "other": other[shared]})

    for batch in batches:
        for bucket, cells, gaps in zip(*(batch[n].to_pylist() for n in PACKED.names)):
            for done in [b for b in held if b != bucket]:
                yield met(done)
            held.setdefault(bucket, []).append((cells, gaps))
    for done in list(held):
        yield met(done)


def _shingles_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        for found in shingle_sets(batch["text"].to_pylist()):
            yield pa.RecordBatch.from_pydict({"shingle": signed(found)})


def _verified(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept, others = [], batch["other"].to_pylist()
            # Pairs come by their second document, whose set is made once for a run of them.
            new = [at == 0 or text != others[at - 1] for at, text in enumerate(others)]
            second = shingle_sets([text for text, start in zip(others, new) if start])
            for x, start in zip(shingle_sets(batch["text"].to_pylist()), new):
                if start:
                    y = next(second)
                common = len(np.intersect1d(x, y, assume_unique=True))
                kept.append(100 * common >= percent * (len(x) + len(y) - common))
            kept = pa.array(kept, pa.bool_())
            yield pa.RecordBatch.from_pydict({"a": batch["a"].filter(kept),
                                              "b": batch["b"].filter(kept)})
    return verify


def _common(docs: DataFrame, classes: DataFrame, sample: int, least: int) -> np.ndarray:
    """Shingles of at least ``least`` of ``sample`` different sets; at most as many as these
    hold over ``least``.  They only steer the sketches."""
    chosen = classes.orderBy(F.xxhash64("rep")).limit(sample).select("rep")
    held = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("rep")).dropDuplicates(
        ["doc_id"]).select("text").mapInArrow(_shingles_of, "shingle long")
    often = held.groupBy("shingle").count().filter(F.col("count") >= least)
    return np.array([row.shingle for row in often.collect()], np.int64).view(np.uint64)


def _pairs_verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    first = texts.select(F.col("doc_id").alias("a"), "text")
    second = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("other"))
    rounds, found = max(1, math.ceil(pairs.count() / max(PAIRS, texts.count()))), []
    for turn in range(rounds):
        part = pairs.select("a", "b").filter(
            F.pmod(F.xxhash64("a", "b"), F.lit(rounds)) == turn) if rounds > 1 else pairs
        found.append(settle(part.select("a", "b").join(first, "a").join(second, "b")
                            .mapInArrow(_verified(percent), "a long, b long"), "links"))
    return reduce(DataFrame.union, found)


def link_documents(docs: DataFrame, percent: int = PERCENT, bucket_cells: int = 1_000_000,
                   sample: int = 4096, least: int = 16) -> tuple[DataFrame, DataFrame]:
    """Every row's doc_id, n and rep of its class; and (id, component) where it is not itself."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    profiles = settle(docs.mapInArrow(_profiles, "doc_id long, n long, name binary, " + ", ".join(
        f"{bits} long" for bits in BITS)), "profiles")
    named = profiles.filter("n > 0 and doc_id is not null")
    classes = settle(named.groupBy("n", "name").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
        *[F.min(bits).alias(bits) for bits in BITS]), "classes")
    copied = classes.filter("copies > 1").select(
        F.col("n").alias("_n"), F.col("name").alias("_name"), "rep")
    members = settle(profiles.join(
        copied, (F.col("n") == F.col("_n")) & (F.col("name") == F.col("_name")), "left").select(
        "doc_id", "n", F.when(F.col("n") > 0, F.coalesce("rep", "doc_id")).alias("rep")), "members")

    common = np.sort(_common(docs, classes, sample, least))
    bands, total = Bands(percent), 0
    for row in classes.groupBy(F.floor(F.log2("n") * 8).alias("step")).agg(
            F.count(F.lit(1)).alias("rows"), F.max("n").alias("top")).collect():
        own = bands.of(row.top)
        total += row.rows * (bands.cells(own) + bands.cells(own + 1))
    buckets = max(1, math.ceil(total / bucket_cells))
    links = members.filter("rep <> doc_id").select(F.col("doc_id").alias("a"),
                                                   F.col("rep").alias("b"))
    # A doc_id with several texts may be a copy by one of them and stand for a class by another.
    copies = settle(links.select("a").distinct().join(
        classes.select("rep"), F.col("a") == F.col("rep"), "left_anti"), "copies")
    packed = docs.filter("doc_id is not null").join(
        copies, F.col("doc_id") == F.col("a"), "left_anti").mapInArrow(
        _pack_cells(buckets, common, percent), "bucket long, cells binary, gaps binary")
    met = settle(packed.repartition(buckets, "bucket").sortWithinPartitions("bucket")
                 .mapInArrow(_meet, "cell long, rep long, other long"), "cells")
    needed = settle(met.select(F.col("rep").alias("_id")).distinct(), "needed")
    told = settle(classes.join(needed, F.col("rep") == F.col("_id"), "left_semi").groupBy(
        "rep").agg(*[F.when(F.count(F.lit(1)) == 1, F.min(name)).alias(name)
                     for name in TOLD]), "told")
    texts = settle(docs.join(needed.hint("merge"), F.col("doc_id") == F.col("_id"), "left_semi"),
                   "texts")
    return members, _joined(met, told, texts, links, percent)


def _joined(met: DataFrame, told: DataFrame, texts: DataFrame, links: DataFrame,
            percent: int) -> DataFrame:
    """(id, component) after verifying what meets in the cells, on top of ``links``.

    First each document is held against the one it shares most cells with among those a cell
    offers it: one of the cell's first component, or of its last to that.  Cells whose members
    are then all in one component are done with, even where thousands of near copies share
    them.  In the others, members of different components are paired off.  No pair is made
    whose sizes or bit sketches differ too much.
    """
    def known(side: str, mark: str = "") -> DataFrame:
        return told.select(F.col("rep").alias(side),
                           *[F.col(name).alias(f"{name}{mark}") for name in TOLD])

    label = components(links)
    # Before the first round every class is a component of its own.
    meets = met.groupBy(F.col("rep").alias("a"), F.col("other").alias("b")).count()
    best = meets.join(known("a"), "a").join(known("b", "_o"), "b").filter(_near(percent)).groupBy(
        "a").agg(F.max(F.struct("count", F.negate("b").alias("b"))).alias("best"))
    first = settle(best.select("a", F.negate(F.col("best.b")).alias("b")), "pairs")
    label = components(_pairs_verified(first, texts, percent).union(label))

    here = met.join(label, F.col("rep") == F.col("id"), "left").select(
        "cell", "rep", F.coalesce("component", "rep").alias("c"))
    open_ = settle(here.groupBy("cell").agg(F.min("c").alias("x"), F.max("c").alias("y")).filter(
        "x <> y").select("cell"), "open-cells")
    here = settle(here.join(open_, "cell"), "open")
    one = here.join(known("rep"), "rep")
    other = here.select("cell", F.col("rep").alias("b"), F.col("c").alias("d")).join(
        known("b", "_o"), "b")
    rest = settle(one.join(other, "cell").filter(
        (F.col("rep") < F.col("b")) & (F.col("c") != F.col("d")) & _near(percent)).select(
        F.col("rep").alias("a"), "b").distinct(), "pairs")
    tried = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    untried = settle(rest.join(tried, ["a", "b"], "left_anti"), "untried")
    found = _pairs_verified(untried, texts, percent)
    return components(found.union(label))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    members, label = link_documents(docs, percent)
    return members.join(label, F.col("doc_id") == F.col("id"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents less those that link, by others too, with one of smaller doc_id.

    Rows that repeat a doc_id are one document: one of them stays.  Rows without doc_id stay.
    """
    members, label = link_documents(docs, percent)
    rest = docs.join(label.select(F.col("id").alias("_gone")),
                     F.col("doc_id") == F.col("_gone"), "left_anti")
    again = settle(members.groupBy(F.col("doc_id").alias("_again")).count().filter(
        "count > 1 and _again is not null").select("_again"), "repeated")
    match = F.col("doc_id") == F.col("_again")
    if again.isEmpty():
        return rest
    once = rest.join(again, match, "left_semi").dropDuplicates(["doc_id"])
    return rest.join(again, match, "left_anti").unionByName(once)
