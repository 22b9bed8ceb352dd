"""Exact top-k search by inner product in three phases under a uniform threshold.

Vectors lie in blocks of rows; queries in blocks of their own; each cell of the two is one
piece of work.  The components are dealt into lists, and a score is the sum of one partial
score per list.

1. A cell takes, per query, the best entries of each of its local lists and adds up their
   whole scores; the k-th best of these is a score that k vectors reach.  The largest over
   all cells is a safe cutoff.
2. The cutoffs go out with the queries.  An entry that reaches the cutoff has a partial score
   of at least cutoff / lists in some list; a cell collects the entries that do.
3. It adds the remaining lists of those entries exactly, keeps what reaches the cutoff, at
   most k a cell, and the few that are left are ranked.

Defined results: vectors that are null or hold a null or non-finite component, and rows
without vec_id, take no part; rows that share a vec_id are one vector, the first in array
order; shorter vectors count as filled up with zeros; ties go to the smaller vec_id; an empty
table gives no rows.  Finite components of any size count exactly: blocks whose scores may pass a
long are computed in whole numbers of any size, which is slower.  A score among the k best that
no long holds raises, and so does a component that times the scale is no double.  Only vec_id and
embedding are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyworks.sources.shared import settle

EXACT, LONGS = 2.0 ** 53, 2.0 ** 62
STEP = 256
SENT = 16 << 20  # bytes of queries that go to every block of vectors at once
PACKED = "block long, ids binary, dims int, matrix binary, cutoffs binary"


def whole_vectors(table: DataFrame, scale: int) -> DataFrame:
    """vec_id and floor(scale * component) of the vectors that take part, one row an id.

    The whole numbers are doubles: from 2^53 on every double is one, and none saturates.
    """
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) != float("inf")))

    def whole(x: Column) -> Column:
        scaled = x.cast("double") * scale
        return F.when(F.abs(scaled) < EXACT, F.floor(scaled).cast("double")).otherwise(scaled)

    return (table.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & usable)
            .select(F.col("vec_id").cast("long"), F.transform("embedding", whole).alias("vector"))
            .groupBy("vec_id").agg(F.min("vector").alias("vector")))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row holding the vectors of a partition as a matrix."""
    held = [batch for batch in batches if batch.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    vectors = table["vector"].combine_chunks()
    lengths = vectors.value_lengths().to_numpy()
    dims = int(lengths.max())
    matrix = np.zeros((len(vectors), dims))
    matrix[np.arange(dims) < lengths[:, None]] = vectors.flatten().to_numpy()
    if not np.isfinite(matrix).all():
        raise OverflowError("a component times the scale is beyond a double")
    yield pa.RecordBatch.from_pydict({
        "block": [TaskContext.get().partitionId()],
        "ids": [table["vec_id"].to_numpy().astype(np.int64).tobytes()], "dims": [dims],
        "matrix": [matrix.tobytes()],
        "cutoffs": [table["cutoff"].to_numpy().astype(np.float64).tobytes()]},
        schema=pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("dims", pa.int32()),
                          ("matrix", pa.binary()), ("cutoffs", pa.binary())]))


def _packed(vectors: DataFrame, blocks: int, name: str) -> DataFrame:
    return settle(vectors.repartition(blocks, "vec_id").mapInArrow(_pack, PACKED), name)


def _cells(vectors: DataFrame, queries: DataFrame) -> Iterator[DataFrame]:
    """Every block of queries beside every block of vectors, dealt by the latter.

    Blocks of queries go out in groups of at most about ``SENT`` bytes, each to be worked off
    before the next, so that neither the driver nor a shuffle holds them once per block of vectors.
    """
    width = sum(F.length(name).cast("long") for name in ("ids", "matrix", "cutoffs"))
    whole = queries.agg(F.sum(width), F.max("block") + 1).first()
    groups = min(math.ceil((whole[0] or 0) / SENT), whole[1] or 0) or 1
    asked = queries.select(
        F.col("block").alias("page"), F.col("ids").alias("asked"),
        F.col("dims").alias("asked_dims"), F.col("matrix").alias("asked_matrix"),
        F.col("cutoffs").alias("asked_cutoffs"))
    for group in range(groups):
        sent = asked.filter(F.col("page") % groups == group).drop("page")
        yield vectors.drop("cutoffs").crossJoin(F.broadcast(sent))


def _worked(vectors: DataFrame, queries: DataFrame, phase, schema: str, name: str) -> DataFrame:
    """What ``phase`` makes of all cells, written group by group."""
    return reduce(DataFrame.union, [settle(cells.mapInArrow(phase, schema), name)
                                    for cells in _cells(vectors, queries)])


def _matrix(data: bytes, ids: np.ndarray, dims: int) -> np.ndarray:
    found = np.frombuffer(data, np.float64).reshape(len(ids), -1)
    return np.pad(found, ((0, 0), (0, dims - found.shape[1])))


def _whole(matrix: np.ndarray, kind: type) -> np.ndarray:
    """The same whole numbers as doubles, longs or Python's integers."""
    if kind is not object:
        return matrix.astype(kind)
    return np.array([int(x) for x in matrix.ravel()] + [None], object)[:-1].reshape(matrix.shape)


def _partials(cell: dict, lists: int) -> Iterator[tuple]:
    """Per step of queries: their ids, cutoffs, the vectors' ids and the lists' partial scores."""
    ids = np.frombuffer(cell["ids"], np.int64)
    asked = np.frombuffer(cell["asked"], np.int64)
    cutoffs = np.frombuffer(cell["asked_cutoffs"], np.float64)
    dims = max(cell["dims"], cell["asked_dims"])
    rows = _matrix(cell["matrix"], ids, dims)
    wanted = _matrix(cell["asked_matrix"], asked, dims)
    top = float(np.abs(rows).max(initial=0)) * float(np.abs(wanted).max(initial=0)) * max(dims, 1)
    kind = np.float64 if top < EXACT else np.int64 if top < LONGS else object
    rows, wanted = _whole(rows, kind).T, _whole(wanted, kind)
    edges = np.linspace(0, dims, lists + 1).astype(int)
    for at in range(0, len(asked), STEP):
        part = wanted[at:at + STEP]
        scores = [part[:, a:b] @ rows[a:b] for a, b in zip(edges, edges[1:])]
        yield asked[at:at + STEP], cutoffs[at:at + STEP], ids, scores


def _cutoffs(k: int, lists: int):
    def phase(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.to_pylist():
                for asked, _, ids, scores in _partials(cell, lists):
                    total, own = sum(scores), asked[:, None] == ids
                    reached = np.full(own.shape, -np.inf)
                    for score in scores:
                        local = np.where(own, -np.inf, score)
                        best = np.argpartition(-local, min(k, local.shape[1]) - 1, axis=1)[:, :k]
                        np.put_along_axis(reached, best, np.take_along_axis(total, best, 1), 1)
                    reached[own] = -np.inf
                    kth = np.sort(reached, axis=1)[:, -k] if len(ids) >= k else np.full(
                        len(asked), -np.inf)
                    kth -= np.where(np.abs(kth) < EXACT, 0, np.abs(kth) * 1e-12)  # rounded: lower
                    yield pa.RecordBatch.from_pydict({"query_id": asked, "cutoff": kth})
    return phase


def _longs(scores: np.ndarray) -> pa.Array:
    """Scores as longs; null stands for one below all longs."""
    if scores.dtype != object:
        return pa.array(scores.astype(np.int64))
    return pa.array([score if score >= -1 << 63 else None for score in scores], pa.int64())


def _entries(k: int, lists: int):
    def phase(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.to_pylist():
                for asked, cutoffs, ids, scores in _partials(cell, lists):
                    uniform = np.where(cutoffs == -np.inf, -np.inf, cutoffs / lists)[:, None]
                    enough = np.logical_or.reduce([score >= uniform for score in scores])
                    row, col = np.nonzero(enough & (asked[:, None] != ids))
                    total = sum(score[row, col] for score in scores)
                    kept = total >= cutoffs[row]
                    row, col, total = row[kept], col[kept], total[kept]
                    order = np.lexsort((ids[col], -total, row))
                    row, col, total = row[order], col[order], total[order]
                    place = np.arange(len(row)) - np.searchsorted(row, row)
                    kept = place < k
                    yield pa.RecordBatch.from_pydict({
                        "query_id": asked[row[kept]], "vec_id": ids[col[kept]],
                        "score": _longs(total[kept])})
    return phase


def search(table: DataFrame, k: int = 5, scale: int = 256, every: int = 50, lists: int = 4,
           block_rows: int = 4096, block_queries: int = 1024) -> DataFrame:
    """The ``k`` best vectors of each query: query_id, rank, vec_id, score.

    Queries are the vectors whose vec_id is divisible by ``every``.
    """
    vectors = settle(whole_vectors(table, scale), "search-vectors")
    asked = vectors.filter(F.col("vec_id") % every == 0)
    rows, queries = vectors.count(), asked.count()
    blocks, pages = math.ceil(rows / block_rows) or 1, math.ceil(queries / block_queries) or 1
    no_cutoff = F.lit(float("-inf"))
    packed = _packed(vectors.withColumn("cutoff", no_cutoff), blocks, "search-blocks")
    first = _packed(asked.withColumn("cutoff", no_cutoff), pages, "search-queries")
    cutoffs = settle(
        _worked(packed, first, _cutoffs(k, lists), "query_id long, cutoff double",
                "search-reached")
        .groupBy("query_id").agg(F.max("cutoff").alias("cutoff")), "search-cutoffs")
    again = asked.join(cutoffs, F.col("vec_id") == F.col("query_id")).drop("query_id")
    found = _worked(packed, _packed(again, pages, "search-cut-queries"), _entries(k, lists),
                    "query_id long, vec_id long, score long", "search-entries")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    held = F.coalesce("score", F.raise_error(F.lit("a score is below all longs")).cast("long"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").filter(
        F.col("rank") <= k).withColumn("score", held)
