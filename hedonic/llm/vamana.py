"""A robust-pruned directed graph over unit vectors, built and searched with numpy.

Every node starts with random neighbours. Node by node (a batch at a time) a greedy
search proposes neighbours; relaxed distance pruning keeps the nearest, drops
whatever is closer to a kept one than to the node, by a factor, and so leaves edges in
all directions. Kept edges are added the other way round too and pruned again where
they are too many.

Searches begin at the entries nearest to the query. Entries are about two square roots of
the number of nodes, each taken farthest from those before, so a group that lies apart
from all others has one of its own, and a beam isn't led into another group that fills it.
Nodes that no entry reaches are chained to a near node that one does reach, so a search
wide enough finds everything.
"""

from __future__ import annotations

import numpy as np

BATCH = 256
EXPANDED = 4
# Entries that a search begins with.
BEGUN = 8


class Graph:
    """Neighbours of each node (-1 where there are fewer), and the nodes where searches may begin."""

    def __init__(self, vectors: np.ndarray, edges: np.ndarray, entries: np.ndarray):
        self.vectors, self.edges, self.entries = vectors, edges, entries

    @classmethod
    def build(cls, vectors: np.ndarray, degree: int = 28, width: int = 56, relaxed: float = 1.2, seed: int = 3) -> Graph:
        n, rng = len(vectors), np.random.default_rng(seed)
        # the last column is kept for the chains to nodes that nothing else reaches
        edges = np.full((n, degree + 1), -1, dtype=np.int32)
        if n > 1:
            own = np.arange(n)[:, None]
            drawn = rng.integers(0, n - 1, (n, min(degree, n - 1)))
            edges[:, : drawn.shape[1]] = _unique_rows(drawn + (drawn >= own))
        graph = cls(vectors, edges, _spread_out(vectors, int(np.ceil(2 * np.sqrt(n)))))
        for factor in (1.0, relaxed):
            order = rng.permutation(n)
            for lo in range(0, n, BATCH):
                graph._insert(order[lo : lo + BATCH], degree, width, factor)
        graph._reach_all(width)
        return graph

    def _insert(self, nodes: np.ndarray, degree: int, width: int, factor: float) -> None:
        _, _, seen = self.search(self.vectors[nodes], width)
        chosen = self._prune(nodes, np.hstack([seen, self.edges[nodes, :degree]]), degree, factor)
        self.edges[nodes, :degree] = chosen
        source, target = np.repeat(nodes, degree), chosen.reshape(-1)
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        heads, first, counts = np.unique(target, return_index=True, return_counts=True)
        # many nodes may propose themselves to one: pad to the most, in chunks of alike sizes
        by_size = np.argsort(counts, kind="stable")
        for lo in range(0, len(heads), BATCH):
            some = by_size[lo : lo + BATCH]
            most = int(counts[some].max())
            place = first[some][:, None] + np.arange(most)
            inside = np.arange(most) < counts[some][:, None]
            incoming = np.where(inside, source[np.minimum(place, len(source) - 1)], -1)
            both = _unique_rows(np.hstack([self.edges[heads[some], :degree], incoming]))
            size = (both >= 0).sum(axis=1)
            fits = size <= degree
            packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), axis=1)
            wide = np.full((len(some), max(degree, packed.shape[1])), -1, dtype=np.int64)
            wide[:, : packed.shape[1]] = packed
            self.edges[heads[some][fits], :degree] = wide[fits, :degree]
            if not fits.all():
                over = heads[some][~fits]
                self.edges[over, :degree] = self._prune(over, both[~fits], degree, factor)

    def _prune(self, nodes: np.ndarray, proposed: np.ndarray, degree: int, factor: float) -> np.ndarray:
        """For each node at most ``degree`` of the proposed ones, diverse in direction."""
        proposed = _unique_rows(np.where(proposed == nodes[:, None], -1, proposed))
        near = self.vectors[np.maximum(proposed, 0)]
        away = _distance(np.matmul(near, self.vectors[nodes][:, :, None])[:, :, 0])
        away = np.where(proposed < 0, np.inf, away)
        out, rows = np.full((len(nodes), degree), -1, dtype=np.int64), np.arange(len(nodes))
        left = away.copy()
        for k in range(degree):
            at = left.argmin(axis=1)
            some = np.isfinite(left[rows, at])
            if not some.any():
                break
            out[some, k] = proposed[rows[some], at[some]]
            between = _distance(np.matmul(near, near[rows, at][:, :, None])[:, :, 0])
            left[(factor * between <= away) | ~some[:, None]] = np.inf
            left[rows, at] = np.inf
        return out

    def _reach_all(self, width: int) -> None:
        n = len(self.vectors)
        if n == 0:
            return
        reached = np.zeros(n, dtype=bool)
        front = self.entries
        reached[front] = True
        while len(front):
            nxt = np.unique(self.edges[front])
            front = nxt[(nxt >= 0) & ~reached[np.maximum(nxt, 0)]]
            reached[front] = True
        lost = np.flatnonzero(~reached)
        for lo in range(0, len(lost), BATCH):
            some = lost[lo : lo + BATCH]
            near = self.search(self.vectors[some], width)[0][:, 0]
            for node, at in zip(some.tolist(), near.tolist()):
                while self.edges[at, -1] >= 0:
                    at = self.edges[at, -1]
                if at != node:
                    self.edges[at, -1] = node

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ``width`` nearest nodes found for each query, their similarities, and all nodes expanded on the way (-1 where fewer)."""
        b, n = len(queries), len(self.vectors)
        rows = np.arange(b)[:, None]
        ids = np.full((b, width), -1, dtype=np.int64)
        score = np.full((b, width), -np.inf, dtype=np.float32)
        fresh = np.zeros((b, width), dtype=bool)
        if not n or not b:
            return ids, score, ids
        first = queries @ self.vectors[self.entries].T
        begun = np.argsort(-first, axis=1, kind="stable")[:, : min(BEGUN, width)]
        k = begun.shape[1]
        ids[:, :k], score[:, :k], fresh[:, :k] = self.entries[begun], np.take_along_axis(first, begun, axis=1), True
        seen = np.zeros((b, n), dtype=bool)
        np.put_along_axis(seen, ids[:, :k], True, axis=1)
        expanded = []
        while True:
            # scores are in order: the first fresh ones are the nearest
            pick = np.argsort(~fresh, axis=1, kind="stable")[:, :EXPANDED]
            valid = np.take_along_axis(fresh, pick, axis=1)
            if not valid.any():
                break
            nodes = np.where(valid, np.take_along_axis(ids, pick, axis=1), -1)
            np.put_along_axis(fresh, pick, False, axis=1)
            expanded.append(nodes)
            around = np.where((nodes < 0)[:, :, None], -1, self.edges[np.maximum(nodes, 0)]).reshape(b, -1)
            around = _unique_rows(around)
            known = (around < 0) | seen[rows, np.maximum(around, 0)]
            around = np.where(known, -1, around)
            # a common number of columns that holds every row's new nodes
            most = int((~known).sum(axis=1).max())
            if not most:
                continue
            order = np.argsort(known, axis=1, kind="stable")[:, :most]
            around = np.take_along_axis(around, order, axis=1)
            new = around >= 0
            r, c = np.nonzero(new)
            seen[r, around[r, c]] = True
            value = np.full(around.shape, -np.inf, dtype=np.float32)
            value[r, c] = np.einsum("ij,ij->i", self.vectors[around[r, c]], queries[r])
            all_ids, all_score, all_fresh = np.hstack([ids, around]), np.hstack([score, value]), np.hstack([fresh, new])
            best = np.argsort(-all_score, axis=1, kind="stable")[:, :width]
            ids, score, fresh = (np.take_along_axis(x, best, axis=1) for x in (all_ids, all_score, all_fresh))
        return ids, score, np.hstack(expanded)

    def to_bytes(self) -> bytes:
        return self.edges.tobytes()


def _spread_out(vectors: np.ndarray, count: int) -> np.ndarray:
    """``count`` different nodes (all, if fewer): the one nearest the mean, then always the one farthest from those taken."""
    n = len(vectors)
    if not n:
        return np.zeros(0, dtype=np.int64)
    out = np.zeros(min(count, n), dtype=np.int64)
    out[0] = np.argmax(vectors @ vectors.mean(axis=0))
    nearest = np.full(n, -np.inf, dtype=np.float32)
    for k in range(1, len(out)):
        nearest = np.maximum(nearest, vectors @ vectors[out[k - 1]])
        nearest[out[k - 1]] = np.inf
        out[k] = np.argmin(nearest)
    return out


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosine, 0))


def _unique_rows(ids: np.ndarray) -> np.ndarray:
    """Each row in order, repeated values replaced by -1."""
    out = np.sort(ids, axis=1)
    out[:, 1:][out[:, 1:] == out[:, :-1]] = -1
    return out
