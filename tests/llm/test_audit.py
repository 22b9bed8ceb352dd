"""Beams that miss links are found out, however few the links are."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from tallyworks.llm import vector_dedup
from tallyworks.llm.graph_index import Graph, links_between

LEAST = 0.98


def sparse(count: int, pairs: int, seed: int) -> np.ndarray:
    """Vectors of which ``pairs`` are a near copy of one other, far from all else."""
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(count, 24))
    some = draw.permutation(count)[:2 * pairs].reshape(2, -1)
    x[some[0]] = x[some[1]] + draw.normal(size=(pairs, 24)) * .05
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Blind(Graph):
    """Its beams meet a vector itself and nothing else."""

    def _insert(self, links, nodes):
        pass

    def search(self, wanted, width):
        near = wanted @ self.vectors[:-1].T
        ids = np.full((len(wanted), width), self.none, np.int64)
        how = np.full(ids.shape, -2, np.float32)
        best = near.argmax(1)
        same = near[np.arange(len(wanted)), best] > 1 - 1e-6
        ids[same, 0], how[same, 0] = best[same], 1
        return ids, how


@pytest.mark.parametrize("apart", [False, True])
def test_links_that_beams_miss(monkeypatch, apart):
    monkeypatch.setattr(vector_dedup, "Graph", Blind)
    x = sparse(4000, 30, 2)
    parts = (x[:2000], x[2000:]) if apart else (x, x)
    ids = [np.arange(len(part)) + (2000 if apart and n else 0) for n, part in enumerate(parts)]
    ones = [np.ones(len(part), np.int64).tobytes() for part in parts]
    cell = {"key": "k", "shard": int(apart), "dims": 24, "asked_shard": 0,
            "ids": ids[1].tobytes(), "copies": ones[1], "matrix": parts[1].tobytes(),
            "asked": ids[0].tobytes(), "asked_copies": ones[0], "asked_matrix": parts[0].tobytes()}
    found = next(vector_dedup._linked(LEAST, 48)(iter([pa.RecordBatch.from_pylist([cell])])))
    near = parts[0] @ parts[1].T >= LEAST
    near &= ids[0][:, None] < ids[1][None, :]
    assert near.sum() >= 10
    assert sum(found["links"].to_pylist()) == 2 * near.sum()
    assert set(found["rep"].to_pylist()) == {
        *ids[0][near.any(1)].tolist(), *ids[1][near.any(0)].tolist()}


def test_audited_beams_find_links():
    """With links enough to audit by, most rows are left to beams."""
    x = sparse(6000, 2500, 4)
    graph, asked, search = Graph(x), [], Graph.search
    graph.search = lambda wanted, width: asked.append(len(wanted)) or search(graph, wanted, width)
    row, node = links_between(graph, x, LEAST, itself=True)
    near = x @ x.T >= LEAST - 1e-4
    assert sum(asked) > 5000
    found = set(zip(row.tolist(), node.tolist()))
    assert found <= set(zip(*(i.tolist() for i in np.nonzero(near))))
    assert sum(a != b for a, b in found) >= 0.98 * (near.sum() - len(x))


@pytest.mark.parametrize("shard_rows", [8192, 1100])
def test_sparse_labels_of_thousands(spark, shard_rows):
    x = np.concatenate([sparse(4000, 60, 7), sparse(3000, 25, 8)]).astype(np.float32)
    label = np.repeat([0, 1], [4000, 3000])
    rows = [(i, v.tolist(), int(n)) for i, (v, n) in enumerate(zip(x, label))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = {r.vec_id: (r.n_links, r.component_id)
             for r in vector_dedup.near_duplicates(table, shard_rows=shard_rows).collect()}
    exact = x.astype(float)
    exact /= np.linalg.norm(exact, axis=1, keepdims=True)
    near = (exact @ exact.T >= LEAST) & (label[:, None] == label)
    assert near.sum() - len(x) > 100
    reach = near.astype(np.float32)
    for _ in range(3):
        reach = (near.astype(np.float32) @ reach > 0).astype(np.float32)
    assert found == {i: (int(near[i].sum()) - 1, int(reach[i].argmax())) for i in range(len(x))}
