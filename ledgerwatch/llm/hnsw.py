"""A hierarchical navigable small-world graph in NumPy, built and searched for
many vectors at a time (Malkov and Yashunin, 2018)."""

from __future__ import annotations

import numpy as np

WIDTH = 4       # beam entries expanded per step


class Graph:
    """Index of the rows of ``x`` (unit vectors). ``level`` is each row's top
    layer. Rows enter in batches that are searched together against the graph
    so far and against each other; neighbours are chosen by the diversity rule
    (closer to the new row than to any neighbour chosen before)."""

    def __init__(self, x: np.ndarray, level: np.ndarray, m: int = 12, ef: int = 48, batch: int = 512):
        self.x, self.m = np.ascontiguousarray(x, np.float32), m
        n = len(x)
        self.layers = []
        for top in range(int(level.max(initial=0)) + 1):
            nodes = np.flatnonzero(level >= top)
            slot = np.full(n, -1, np.int64)
            slot[nodes] = np.arange(len(nodes))
            self.layers.append((slot, np.full((len(nodes), 2 * m if top == 0 else m), -1, np.int64)))
        self.entry = np.full(len(self.layers), -1, np.int64)     # a row of each layer
        at = 0
        while at < n:
            to = min(n, at + min(batch, max(64, at)))
            self._insert(np.arange(at, to), level[at:to], ef)
            at = to
        self.more = self._unreached()

    def _insert(self, new: np.ndarray, level: np.ndarray, ef: int) -> None:
        q = self.x[new]
        mates = q @ q.T
        np.fill_diagonal(mates, -2)
        start = None
        for top in range(len(self.layers) - 1, -1, -1):
            here = level >= top
            if self.entry[top] >= 0:
                first = np.full((len(new), 1), self.entry[top]) if start is None else start
                found, sims = self.beam(q, first, ef if here.any() else 1, top)
                start = np.where(found[:, :1] >= 0, found[:, :1], self.entry[top])
            else:
                found, sims = np.zeros((len(new), 0), np.int64), np.zeros((len(new), 0), np.float32)
            some = np.flatnonzero(here)
            if not len(some):
                continue
            among = mates[np.ix_(some, some)]
            k = min(32, len(some))
            near = np.argpartition(-among, k - 1, axis=1)[:, :k]
            cand = np.concatenate([found[some], np.where(np.take_along_axis(among, near, 1) > -2, new[some][near], -1)], axis=1)
            close = np.concatenate([sims[some], np.take_along_axis(among, near, 1)], axis=1)
            slot, adj = self.layers[top]
            chosen = self._choose(cand, close, adj.shape[1] // (2 if top == 0 else 1))
            adj[slot[new[some]], : chosen.shape[1]] = chosen
            self._back(top, np.repeat(new[some], chosen.shape[1]), chosen.ravel())
            if self.entry[top] < 0:
                self.entry[top] = new[some[0]]

    def _choose(self, cand: np.ndarray, close: np.ndarray, most: int) -> np.ndarray:
        order = np.argsort(-close, axis=1, kind="stable")[:, :64]
        cand, close = np.take_along_axis(cand, order, 1), np.take_along_axis(close, order, 1)
        out = np.full((len(cand), most), -1, np.int64)
        for at in range(0, len(cand), 256):
            c, s = cand[at: at + 256], close[at: at + 256]
            v = self.x[np.maximum(c, 0)]
            between = np.matmul(v, v.transpose(0, 2, 1))
            taken, count = np.zeros(c.shape, bool), np.zeros(len(c), np.int64)
            for j in range(c.shape[1]):
                ok = (c[:, j] >= 0) & (count < most) & ~((between[:, j] >= s[:, j: j + 1]) & taken).any(axis=1)
                taken[ok, j] = True
                count += ok
            # diverse neighbours first; the closest others fill the free places
            order = np.argsort(np.where(taken, 0, np.where(c >= 0, 1, 2)), axis=1, kind="stable")[:, :most]
            out[at: at + 256, : order.shape[1]] = np.take_along_axis(c, order, 1)
        return out

    def _back(self, top: int, source: np.ndarray, target: np.ndarray) -> None:
        """Links back from chosen neighbours, pruned by the same rule."""
        slot, adj = self.layers[top]
        keep = target >= 0
        source, target = source[keep], target[keep]
        if not len(target):
            return
        order = np.lexsort((source, target))
        source, target = source[order], target[order]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(first, count)
        extra = np.full((len(nodes), int(count.max())), -1, np.int64)
        extra[np.repeat(np.arange(len(nodes)), count), place] = source
        cand = np.concatenate([adj[slot[nodes]], extra], axis=1)
        cand.sort(axis=1)
        cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
        close = np.einsum("ijk,ik->ij", self.x[np.maximum(cand, 0)], self.x[nodes])
        close[cand < 0] = -3
        room = (cand >= 0).sum(axis=1) <= adj.shape[1]
        sort = np.argsort(-close, axis=1, kind="stable")[:, : adj.shape[1]]
        all_of = np.take_along_axis(cand, sort, 1)
        if all_of.shape[1] < adj.shape[1]:
            all_of = np.pad(all_of, ((0, 0), (0, adj.shape[1] - all_of.shape[1])), constant_values=-1)
        adj[slot[nodes]] = all_of
        full = np.flatnonzero(~room)
        if len(full):
            adj[slot[nodes[full]]] = self._choose(cand[full], close[full], adj.shape[1])

    def _unreached(self) -> np.ndarray:
        """One more entry for each part of the ground layer that can't be
        reached from the first entry."""
        adj = self.layers[0][1]
        seen = np.zeros(len(adj), bool)
        more = []
        for root in [int(self.entry[0]), *range(len(adj))] if len(adj) else []:
            if seen[root]:
                continue
            more.append(root)
            seen[root] = True
            edge = np.array([root])
            while len(edge):
                edge = np.unique(adj[edge])
                edge = edge[edge >= 0]
                edge = edge[~seen[edge]]
                seen[edge] = True
        return np.array(more[1:], np.int64)

    def beam(self, q: np.ndarray, start: np.ndarray, ef: int, top: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The ``ef`` best rows found from ``start`` (a row of candidates per
        query) on one layer, best first, with their similarities; -1 and -2
        fill up."""
        slot, adj = self.layers[top]
        seen = np.zeros((len(q), len(self.x)), bool)
        ids, sims = np.full((len(q), ef), -1, np.int64), np.full((len(q), ef), -2, np.float32)
        fresh = np.zeros((len(q), ef), bool)
        rows, cand = np.arange(len(q)), start
        while True:
            cand = np.sort(cand, axis=1)
            good = cand >= 0
            good[:, 1:] &= cand[:, 1:] != cand[:, :-1]
            good &= ~seen[rows[:, None], np.maximum(cand, 0)]
            r, c = np.nonzero(good)
            node = cand[r, c]
            seen[rows[r], node] = True
            value = np.full(cand.shape, -2, np.float32)
            value[r, c] = np.einsum("ij,ij->i", self.x[node], q[rows[r]])
            all_sims = np.concatenate([sims[rows], value], axis=1)
            best = np.argpartition(-all_sims, ef - 1, axis=1)[:, :ef]
            sims[rows] = np.take_along_axis(all_sims, best, 1)
            ids[rows] = np.take_along_axis(np.concatenate([ids[rows], np.where(good, cand, -1)], axis=1), best, 1)
            fresh[rows] = np.take_along_axis(np.concatenate([fresh[rows], good], axis=1), best, 1)
            rows = rows[fresh[rows].any(axis=1)]
            if not len(rows):
                break
            width = min(WIDTH, ef)
            score = np.where(fresh[rows], sims[rows], -4)
            pick = np.argpartition(-score, width - 1, axis=1)[:, :width]
            valid = np.take_along_axis(score, pick, 1) > -4
            node = np.where(valid, np.take_along_axis(ids[rows], pick, 1), -1)
            fresh[rows[:, None], pick] = False
            cand = np.where(node[:, :, None] >= 0, adj[slot[np.maximum(node, 0)]], -1).reshape(len(rows), -1)
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)

    def search(self, q: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """From the top layer down, then a beam of ``ef`` on the ground layer."""
        q = np.ascontiguousarray(q, np.float32)
        start = np.full((len(q), 1), self.entry[-1])
        for top in range(len(self.layers) - 1, 0, -1):
            start = self.beam(q, start, 1, top)[0]
        if len(self.more):
            start = np.concatenate([start, np.tile(self.more, (len(q), 1))], axis=1)
        return self.beam(q, start, min(ef, len(self.x)))
