"""Hierarchical navigable small-world graph over the vectors of one shard, in numpy.

Layers hold ever fewer nodes; each is built from the layer above, whose nodes go in first.
Nodes are inserted and searched in batches: one beam per row, advanced together.  A node
keeps neighbours that are nearer to it than to each other, so that clusters of near copies
stay joined to the rest.
"""

from __future__ import annotations

import numpy as np

NEIGHBOURS, BEAM, BATCH, WIDE = 24, 48, 256, 4


class Graph:
    """Vectors of unit length and, per layer from the top, its nodes and their neighbours."""

    def __init__(self, vectors: np.ndarray, seed: int = 5):
        self.vectors = np.vstack([vectors, np.zeros((1, vectors.shape[1]))]).astype(np.float32)
        count = len(vectors)
        self.none = count
        draw = np.random.default_rng(seed)
        heights = np.floor(-np.log(1 - draw.random(count)) / np.log(NEIGHBOURS)).astype(int)
        order = draw.permutation(count)
        self.layers: list[np.ndarray] = []
        self.top = int(order[np.argmax(heights[order])])
        above = np.zeros(0, np.int64)
        for height in range(int(heights.max()), -1, -1):
            nodes = order[heights[order] >= height]
            fresh = nodes[~np.isin(nodes, above)]
            links = np.full((count + 1, NEIGHBOURS), self.none, np.int64)
            self._insert(links, np.concatenate([above, fresh]))
            self.layers.append(links)
            above = nodes

    def _insert(self, links: np.ndarray, nodes: np.ndarray) -> None:
        placed = nodes[:1]
        while len(placed) < len(nodes):
            batch = nodes[len(placed):len(placed) + min(BATCH, max(32, len(placed)))]
            near = self.vectors[batch] @ self.vectors[batch].T
            np.fill_diagonal(near, -2)
            own = np.argsort(-near, axis=1)[:, :NEIGHBOURS]
            found, _ = self._beam(links, batch, self._entry(batch, placed), BEAM)
            candidates = np.hstack([found, batch[own]])
            links[batch] = self._chosen(batch, candidates)
            self._back(links, batch)
            placed = np.concatenate([placed, batch])

    def _entry(self, batch: np.ndarray, placed: np.ndarray) -> np.ndarray:
        """The nearest node of the layer above; the first placed one in the top layer."""
        entry = np.full(len(batch), self.top if self.layers else placed[0])
        for links in self.layers:
            entry = self._beam(links, batch, entry, 8)[0][:, 0]
        return np.where(np.isin(entry, placed), entry, placed[0])

    def _chosen(self, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """Of each row of candidates those nearer to the node than to one chosen before."""
        candidates = np.sort(np.where(candidates == nodes[:, None], self.none, candidates), 1)
        repeated = np.zeros(candidates.shape, bool)
        repeated[:, 1:] = candidates[:, 1:] == candidates[:, :-1]
        candidates = np.where(repeated, self.none, candidates)
        near = np.einsum("bd,bkd->bk", self.vectors[nodes], self.vectors[candidates])
        near[candidates == self.none] = -2
        order = np.argsort(-near, axis=1)
        candidates = np.take_along_axis(candidates, order, 1)
        near = np.take_along_axis(near, order, 1)
        some = self.vectors[candidates]
        between = some @ some.transpose(0, 2, 1)
        kept = np.zeros(candidates.shape, bool)
        for k in range(candidates.shape[1]):
            shadowed = (kept & (between[:, k] > near[:, k, None])).any(1)
            kept[:, k] = ~shadowed & (candidates[:, k] != self.none)
        first = np.argsort(~kept, axis=1, kind="stable")[:, :NEIGHBOURS]
        best = np.take_along_axis(candidates, first, 1)
        short = NEIGHBOURS - best.shape[1]
        return np.pad(best, ((0, 0), (0, short)), constant_values=self.none)

    def _back(self, links: np.ndarray, batch: np.ndarray) -> None:
        """Links in the other direction, chosen anew where a node has more than it keeps."""
        target, source = links[batch].ravel(), np.repeat(batch, NEIGHBOURS)
        real = target != self.none
        target, source = target[real], source[real]
        near = np.einsum("nd,nd->n", self.vectors[target], self.vectors[source])
        order = np.lexsort((-near, target))
        target, source = target[order], source[order]
        nodes, first = np.unique(target, return_index=True)
        place = np.arange(len(target)) - np.repeat(first, np.diff([*first, len(target)]))
        fits = place < NEIGHBOURS
        extra = np.full((len(nodes), NEIGHBOURS), self.none, np.int64)
        extra[np.searchsorted(nodes, target[fits]), place[fits]] = source[fits]
        for at in range(0, len(nodes), BATCH):
            part = slice(at, at + BATCH)
            links[nodes[part]] = self._chosen(
                nodes[part], np.hstack([links[nodes[part]], extra[part]]))

    def _beam(self, links: np.ndarray, asked: np.ndarray, entry: np.ndarray,
              width: int) -> tuple[np.ndarray, np.ndarray]:
        return self.beam(links, self.vectors[asked], entry, width)

    def beam(self, links: np.ndarray, wanted: np.ndarray, entry: np.ndarray,
             width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest nodes each row's beam meets, and how near, nearest first."""
        rows = np.arange(len(wanted))[:, None]
        seen = np.zeros((len(wanted), self.none + 1), bool)
        seen[:, self.none] = True
        ids = np.full((len(wanted), width), self.none, np.int64)
        near = np.full(ids.shape, -2, np.float32)
        done = np.ones(ids.shape, bool)
        ids[:, 0] = entry
        near[:, 0] = np.einsum("bd,bd->b", wanted, self.vectors[entry])
        done[:, 0] = False
        seen[rows[:, 0], entry] = True
        while True:
            open_ = np.where(done, -3, near)
            step = np.argsort(-open_, axis=1)[:, :WIDE]
            going = np.take_along_axis(open_, step, 1) > -3
            if not going.any():
                return ids, near
            np.put_along_axis(done, step, True, 1)
            ahead = np.where(going, np.take_along_axis(ids, step, 1), self.none)
            fresh = np.sort(links[ahead].reshape(len(wanted), -1), axis=1)
            again = np.zeros(fresh.shape, bool)
            again[:, 1:] = fresh[:, 1:] == fresh[:, :-1]
            fresh = np.where(again | seen[rows, fresh], self.none, fresh)
            seen[rows, fresh] = True
            how = np.einsum("bd,bkd->bk", wanted, self.vectors[fresh])
            how[fresh == self.none] = -2
            ids, near = np.hstack([ids, fresh]), np.hstack([near, how])
            done = np.hstack([done, fresh == self.none])
            order = np.argsort(-near, axis=1, kind="stable")[:, :width]
            ids, near, done = (np.take_along_axis(x, order, 1) for x in (ids, near, done))

    def search(self, wanted: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        entry = np.full(len(wanted), self.top)
        for links in self.layers[:-1]:
            entry = self.beam(links, wanted, entry, 8)[0][:, 0]
        return self.beam(self.layers[-1], wanted, entry, width)


def links_between(graph: Graph, wanted: np.ndarray, least: float, width: int = BEAM,
                  audits: int = 64, recall: float = 0.98, seed: int = 3,
                  itself: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of ``wanted``, node) with a product of at least about ``least``.

    Rows drawn by chance are held against all nodes until ``audits`` of them have a link that
    a beam should find; they are settled by that.  Where beams find too few of their links,
    all beams are widened.  A row whose whole beam is that near may have missed nodes: its beam
    is widened too, and audited anew.  So where links are too few to audit beams by, every row
    is held against all nodes.  With ``itself`` row and node of one number are the same vector,
    which is no link.  The widest beam is the whole shard.
    """
    count, slack = graph.none, least - 1e-4
    wanted = wanted.astype(np.float32)
    left = np.random.default_rng(seed).permutation(len(wanted))
    pairs = [np.zeros((2, 0), np.int64)]
    while len(left):
        whole, linked, at = width * 8 >= count, [], 0
        while at < len(left) and (whole or sum(map(len, linked)) < audits):
            rows = left[at:at + BATCH]
            row, node = np.nonzero(wanted[rows] @ graph.vectors[:-1].T >= slack)
            pairs.append(np.stack([rows[row], node]))
            true = np.bincount(row[(not itself) | (rows[row] != node)], minlength=len(rows))
            linked.append(np.stack([rows, true], 1)[(true > 0) & (true < width)])
            at += BATCH
        left = left[at:]
        if not len(left):
            break
        rows, true = np.concatenate(linked).T
        found, again = _by_beams(graph, wanted, rows, slack, width)
        met = np.bincount(found[0][(not itself) | (found[0] != found[1])], minlength=len(wanted))[rows]
        met, true = (x[~np.isin(rows, again)] for x in (met, true))
        if not len(true) or min(met.sum() / true.sum(), (met / true).mean()) < recall:
            width *= 4
            continue
        found, left = _by_beams(graph, wanted, left, slack, width)
        pairs.append(found)
        width *= 4
    row, node = np.hstack(pairs)
    return row, node


def _by_beams(graph: Graph, wanted: np.ndarray, rows: np.ndarray, slack: float,
              width: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that beams of the rows find, and the rows whose whole beam is near."""
    found, again = [np.zeros((2, 0), np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, len(rows), BATCH):
        some = rows[at:at + BATCH]
        ids, near = graph.search(wanted[some], min(width, graph.none))
        full = near[:, -1] >= slack
        again.append(some[full])
        row, place = np.nonzero((near >= slack) & ~full[:, None])
        found.append(np.stack([some[row], ids[row, place]]))
    return np.hstack(found), np.concatenate(again)
