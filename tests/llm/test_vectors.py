"""The graph's recall, and near-duplicate vectors against all pairs."""

from __future__ import annotations

import numpy as np
import pytest
from tallyworks.llm.graph_index import Graph, links_between
from tallyworks.llm.vector_dedup import near_duplicates

SCHEMA = "vec_id long, embedding array<float>, label int"


def clustered(count: int, seed: int = 0) -> np.ndarray:
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(count, 24))
    for _ in range(count // 40):
        x[draw.integers(0, count, 10)] = x[draw.integers(0, count)] + draw.normal(size=(10, 24)) * .08
    x[:count // 10] = draw.normal(size=24) + draw.normal(size=(count // 10, 24)) * .06
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def test_graph_recall():
    x = clustered(2000)
    graph, near = Graph(x), x @ x.T
    found, _ = graph.search(x[:200], 48)
    best = [len(set(found[i][:10]) & set(np.argsort(-near[i])[:10])) / 10 for i in range(200)]
    assert np.mean(best) >= 0.9
    row, node = links_between(graph, x, 0.98, width=16)
    assert len(set(zip(row, node))) >= 0.99 * (near >= 0.98).sum()


@pytest.mark.parametrize("size", [1, 2, 5, 30])
def test_tiny_graphs(size):
    x = clustered(40)[:size]
    row, node = links_between(Graph(x), x, 0.98)
    assert set(zip(row, node)) == set(zip(*np.nonzero(x @ x.T >= 0.98 - 1e-4)))


def brute_force(rows):
    usable = {}
    for at, (_, vector, label) in enumerate(rows):
        if label is not None and vector and all(x is not None and np.isfinite(x) for x in vector):
            if any(vector):
                usable[at] = np.array(vector, np.float32).astype(float)
    links, root = dict.fromkeys(range(len(rows)), 0), {i: i for i in range(len(rows))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, x in usable.items():
        for b, y in usable.items():
            if a < b and rows[a][2] == rows[b][2] and len(x) == len(y):
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.98:
                    links[a] += 1
                    links[b] += 1
                    root[find(b)] = find(a)
    parts = {}
    for i in root:
        parts.setdefault(find(i), []).append(rows[i][0])
    return sorted((rows[i][0], links[i], min(parts[find(i)])) for i in root)


@pytest.mark.parametrize("shard_rows", [8192, 60])
def test_links_and_components(spark, shard_rows):
    x = clustered(400, 3)
    rows = [(i, [float(v) for v in x[i]], i % 3) for i in range(400)]
    rows += [(400 + i, rows[i % 5][1], i % 3) for i in range(60)]  # exact copies
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = near_duplicates(table, shard_rows=shard_rows).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == brute_force(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_odd_rows(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1),
            (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1), (7, [None, 1.0], 1), (8, [1.0, 0.0, 0.0], 1),
            (9, [1.0, 0.0], 2), (10, [], 1), (11, [float("inf"), 0.0], 1)]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 AS key", "2 AS shard", "3 AS rep", "4 AS vector", "5 AS id", "6 AS _n")
    found = near_duplicates(table).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == brute_force(rows)
    repeated = spark.createDataFrame(rows[:1] * 3 + [(None, [1.0, 0.0], 1)], SCHEMA)
    assert [(r.vec_id, r.n_links, r.component_id) for r in near_duplicates(repeated).sort(
        "vec_id").collect()] == [(None, 0, None)] + [(1, 2, 1)] * 3
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
