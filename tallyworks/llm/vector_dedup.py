"""Embedding near-dedup with a navigable small-world graph per shard.

Equal vectors of a label are one class.  Classes of a label are dealt into shards of bounded
size; a graph is built per shard, and the classes of every shard ask it and the shards after
it, so each pair of shards meets once.  Beams widen until audits of rows that have links,
against all nodes of the shard, pass; a pair of shards with too few links to audit by is
compared whole.  The cosine of what they find is computed in double precision; links are counted
where they are found, and a spanning forest of them goes on to the components.

Defined results: vectors that are null, zero or hold a null or non-finite component, and rows
with a null label, link with nothing and are their own component; vectors of different length
do not link; a row with null vec_id has no links and a null component; rows that repeat a
vec_id count as rows, under one component; an empty table gives no rows.  Only vec_id,
embedding and label are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.components import components
from tallyworks.llm.graph_index import Graph, links_between
from tallyworks.sources.shared import settle

SHARDS = "key string, shard long, ids binary, copies binary, dims int, matrix binary"


def _shard(table: pa.Table) -> pa.Table:
    """The vectors of a shard as one row."""
    vectors = table["vector"].combine_chunks()
    return pa.table({
        "key": [table["key"][0].as_py()], "shard": [table["shard"][0].as_py()],
        "ids": [table["rep"].to_numpy().astype(np.int64).tobytes()],
        "copies": [table["copies"].to_numpy().astype(np.int64).tobytes()],
        "dims": pa.array([len(vectors.flatten()) // len(vectors)], pa.int32()),
        "matrix": [vectors.flatten().to_numpy().astype(np.float64).tobytes()]})


def _roots(first: np.ndarray, second: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links: each node with its tree's smallest."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        while parent.setdefault(node, node) != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    for a, b in zip(first.tolist(), second.tolist()):
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [(node, root(node)) for node in parent]


def _unit(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _linked(least: float, beam: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built: tuple = (None, None)
        for batch in batches:
            for cell in batch.to_pylist():
                dims = cell["dims"]
                ids, copies = (np.frombuffer(cell[n], np.int64) for n in ("ids", "copies"))
                nodes = np.frombuffer(cell["matrix"], np.float64).reshape(-1, dims)
                asked, more = (np.frombuffer(cell[n], np.int64) for n in ("asked", "asked_copies"))
                wanted = np.frombuffer(cell["asked_matrix"], np.float64).reshape(-1, dims)
                name = (cell["key"], cell["shard"])
                if built[0] != name:
                    built = (name, Graph(_unit(nodes)))
                row, node = links_between(built[1], _unit(wanted), least, beam,
                                          itself=cell["asked_shard"] == cell["shard"])
                exact = np.einsum("nd,nd->n", wanted[row], nodes[node]) / (
                    np.linalg.norm(wanted, axis=1)[row] * np.linalg.norm(nodes, axis=1)[node])
                real = (exact >= least) & (asked[row] != ids[node])
                row, node = row[real], node[real]
                if cell["asked_shard"] == cell["shard"]:  # a shard asks itself: each pair once
                    pairs = np.unique(np.sort(np.stack([row, node], 1), axis=1), axis=0)
                    row, node = pairs[:, 0], pairs[:, 1]
                rep = np.concatenate([asked[row], ids[node]])
                count = np.concatenate([copies[node], more[row]])
                reps, place = np.unique(rep, return_inverse=True)
                forest = dict(_roots(asked[row], ids[node]))
                yield pa.RecordBatch.from_pydict({
                    "rep": pa.array(reps, pa.int64()),
                    "links": pa.array(np.bincount(place, count, len(reps)).astype(np.int64)),
                    "root": pa.array([forest[r] for r in reps.tolist()], pa.int64())})
    return link


def near_duplicates(table: DataFrame, least: float = 0.98, shard_rows: int = 8192,
                    beam: int = 48) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) != float("inf")))
    usable = (finite & F.exists("embedding", lambda x: x != 0) & F.col("label").isNotNull()
              & F.col("vec_id").isNotNull())
    rows = table.select(
        F.col("vec_id").cast("long"), F.when(F.coalesce(usable, F.lit(False)), F.concat_ws(
            ":", F.col("label").cast("string"), F.size("embedding"))).alias("key"),
        F.transform("embedding", lambda x: x.cast("double")).alias("vector"))
    classes = settle(
        rows.filter("key is not null").groupBy("key", "vector").agg(
            F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "vector-classes")
    sizes = settle(classes.groupBy(F.col("key").alias("_key")).agg(
        F.ceil(F.count(F.lit(1)) / shard_rows).alias("_shards")), "vector-shards")
    dealt = classes.join(sizes, F.col("key") == F.col("_key")).withColumn(
        "shard", F.pmod(F.xxhash64("rep"), F.col("_shards")))
    shards = settle(dealt.select("key", "shard", "rep", "copies", "vector")
                    .groupBy("key", "shard").applyInArrow(_shard, SHARDS), "vector-blocks")
    asked = shards.join(sizes, F.col("key") == F.col("_key")).select(
        "key", F.explode(F.sequence(F.col("shard"), F.col("_shards") - 1)).alias("shard"),
        F.col("shard").alias("asked_shard"), F.col("ids").alias("asked"),
        F.col("copies").alias("asked_copies"), F.col("matrix").alias("asked_matrix"))
    found = settle(shards.join(asked, ["key", "shard"]).mapInArrow(
        _linked(least, beam), "rep long, links long, root long"), "vector-links")
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = found.groupBy(F.col("rep").alias("_rep")).agg(F.sum("links").alias("_links"))
    known = settle(
        classes.join(links, F.col("rep") == F.col("_rep"), "left")
        .join(roots, F.col("rep") == F.col("id"), "left")
        .select(F.col("key").alias("_key"), F.col("vector").alias("_vector"),
                (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("_n"),
                F.coalesce("component", "rep").alias("_component")), "vector-known")
    component = F.coalesce("_component", "vec_id")
    return rows.join(
        known, (F.col("key") == F.col("_key")) & (F.col("vector") == F.col("_vector")), "left"
    ).select("vec_id", F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"),
             component.alias("component_id"), (component == F.col("vec_id")).alias("kept"))
