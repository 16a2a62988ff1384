"""A hierarchical navigable small-world graph over unit vectors, by array operations.

Many points or queries walk the graph together. Layers are built from the sparse
top down; within a layer points join in growing batches, and each finds its way
from where the finished layers above lead it.
"""

from __future__ import annotations

import numpy as np

LINKS = 12  # neighbours a point keeps; twice as many at the bottom
BEAM = 32  # while building
AT_ONCE = 8  # beam entries opened in one step
TOGETHER = 512  # walkers in one go


def _top(ids: np.ndarray, sims: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(-sims, axis=1)[:, :keep]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def _fresh(ids: np.ndarray) -> np.ndarray:
    """True for the first of equal ids in each row, False for -1."""
    order = np.argsort(ids, axis=1, kind="stable")
    rows = np.take_along_axis(ids, order, 1)
    first = np.ones_like(rows, dtype=bool)
    first[:, 1:] = rows[:, 1:] != rows[:, :-1]
    out = np.empty_like(first)
    np.put_along_axis(out, order, first & (rows >= 0), 1)
    return out


class Graph:
    def __init__(self, vectors: np.ndarray, seed: int = 5, links: int = LINKS, beam: int = BEAM) -> None:
        self.x = np.ascontiguousarray(vectors, dtype=np.float32)
        n = len(self.x)
        rng = np.random.default_rng(seed)
        level = np.floor(-np.log(1 - rng.random(n)) / np.log(max(links, 2))).astype(int)
        # Points of higher levels come first in every layer below.
        self.order = np.lexsort((rng.random(n), -level))
        sizes = [int((level >= k).sum()) for k in range(int(level.max(initial=0)) + 1)]
        self.layers: list[np.ndarray] = []  # top first: neighbours of the first so many of the order
        for k in range(len(sizes) - 1, -1, -1):
            self._grow(sizes[k], 2 * links if k == 0 else links, beam)

    def _walk(self, nb: np.ndarray, q: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Beams of places in the order, best first, from ``entry`` (one place or more a walker)."""
        y = self.placed
        # A beam entry is twice its place, and one more once it was opened.
        ids = np.full((len(q), beam), -1, dtype=np.int64)
        sims = np.full((len(q), beam), -np.inf, dtype=np.float32)
        e = entry[:, :beam]
        good = _fresh(e)
        ids[:, : e.shape[1]] = np.where(good, 2 * e, -1)
        sims[:, : e.shape[1]] = np.where(good, np.einsum("qd,qed->qe", q, y[np.maximum(e, 0)]), -np.inf)
        seen = np.zeros((len(q), len(nb)), dtype=bool)
        turn = np.empty((len(q), len(nb)), dtype=np.int16)
        r, c = np.nonzero(ids >= 0)
        seen[r, ids[r, c] >> 1] = True
        live = np.arange(len(q))
        most = min(AT_ONCE, beam)
        while len(live):
            i, s = ids[live], sims[live]
            waiting = np.where(i & 1, -np.inf, s)  # -1 counts as opened
            pick = np.argpartition(-waiting, most - 1, axis=1)[:, :most] if most < beam else np.tile(np.arange(beam), (len(live), 1))
            busy = np.take_along_axis(waiting, pick, 1) > -np.inf
            more = busy.any(axis=1)
            live, i, s, pick, busy = live[more], i[more], s[more], pick[more], busy[more]
            if not len(live):
                break
            at = np.take_along_axis(i, pick, 1)
            np.put_along_axis(i, pick, at | 1, 1)
            new = np.where(busy[:, :, None], nb[np.maximum(at >> 1, 0)], -1).reshape(len(live), -1)
            r, c = np.nonzero(new >= 0)
            k = new[r, c]
            fresh = ~seen[live[r], k]
            r, c, k = r[fresh], c[fresh], k[fresh]
            turn[live[r], k] = c  # of equal places in a row, the last written stays
            fresh = turn[live[r], k] == c
            r, c, k = r[fresh], c[fresh], k[fresh]
            seen[live[r], k] = True
            got = np.full(new.shape, -np.inf, dtype=np.float32)
            got[r, c] = np.einsum("kd,kd->k", q[live[r]], y[k])
            both = np.concatenate([s, got], axis=1)
            place = np.concatenate([i, 2 * new], axis=1)
            best = np.argpartition(-both, beam - 1, axis=1)[:, :beam]
            sims[live] = kept = np.take_along_axis(both, best, 1)
            ids[live] = np.where(kept > -np.inf, np.take_along_axis(place, best, 1), -1)
        ids >>= 1
        return _top(ids, sims, beam)

    def _spread(self, ids: np.ndarray, sims: np.ndarray, keep: int) -> np.ndarray:
        """Of candidates sorted by similarity, those nearer to the point than to any kept one; then the best of the rest."""
        y = self.placed[np.maximum(ids, 0)]
        among = y @ y.transpose(0, 2, 1)
        kept = np.zeros(ids.shape, dtype=bool)
        valid = ids >= 0
        for j in range(ids.shape[1]):
            near = (np.where(kept, among[:, j, :], -np.inf) >= sims[:, j : j + 1]).any(axis=1)
            kept[:, j] = valid[:, j] & ~near & (kept.sum(axis=1) < keep)
        rank = np.where(kept, 0, np.where(valid, 1, 2))
        order = np.argsort(rank, axis=1, kind="stable")[:, :keep]
        out = np.take_along_axis(np.where(valid, ids, -1), order, 1)
        if out.shape[1] < keep:
            out = np.pad(out, ((0, 0), (0, keep - out.shape[1])), constant_values=-1)
        return out

    def _grow(self, size: int, links: int, beam: int) -> None:
        self.placed = self.x[self.order]
        nb = np.full((size, links), -1, dtype=np.int64)
        done = min(size, links)
        if done > 1:
            s = self.placed[:done] @ self.placed[:done].T
            np.fill_diagonal(s, -np.inf)
            ids, sims = _top(np.tile(np.arange(done), (done, 1)), s, done - 1)
            nb[:done] = self._spread(ids, sims, links)
        while done < size:
            upto = min(size, done + min(done, TOGETHER))
            q = self.placed[done:upto]
            ids, sims = self._walk(nb[:done], q, self._entry(q, done), min(beam, done))
            # Points that join together see each other too.
            s = q @ q.T
            np.fill_diagonal(s, -np.inf)
            mine, own = _top(np.tile(np.arange(done, upto), (len(q), 1)), s, min(links, len(q)))
            ids, sims = _top(np.concatenate([ids, np.where(np.isfinite(own), mine, -1)], axis=1), np.concatenate([sims, own], axis=1), beam)
            nb[done:upto] = self._spread(ids, sims, links)
            self._back(nb, np.arange(done, upto))
            done = upto
        self.layers.append(nb)

    def _back(self, nb: np.ndarray, new: np.ndarray) -> None:
        """Make the new points known to the neighbours they chose."""
        links = nb.shape[1]
        src = np.repeat(new, links)
        dst = nb[new].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        known = ~(nb[dst] == src[:, None]).any(axis=1)
        src, dst = src[known], dst[known]
        while len(dst):
            # At most ``links`` newcomers a point at a time, the others in the next turn.
            first = np.flatnonzero(np.concatenate([[True], dst[1:] != dst[:-1]]))
            n = np.diff(first, append=len(dst))
            rank = np.arange(len(dst)) - np.repeat(first, n)
            now = rank < links
            points = dst[first]
            add = np.full((len(points), links), -1, dtype=np.int64)
            row = np.repeat(np.arange(len(points)), n)
            add[row[now], rank[now]] = src[now]
            ids = np.concatenate([nb[points], add], axis=1)
            sims = np.where(ids >= 0, np.einsum("pd,pcd->pc", self.placed[points], self.placed[np.maximum(ids, 0)]), -np.inf)
            ids, sims = _top(ids, sims, 2 * links)
            ids = np.where(np.isfinite(sims), ids, -1)
            nb[points] = self._spread(ids, sims, links)
            src, dst = src[~now], dst[~now]

    def _entry(self, q: np.ndarray, below: int, beam: int = 4) -> np.ndarray:
        """Places from which to enter the layer under the finished ones."""
        at = np.zeros((len(q), 1), dtype=np.int64)
        for nb in self.layers:
            at = self._walk(nb, q, at, min(beam, len(nb)))[0]
        return np.where(at < below, at, -1) if (at < below).any(axis=1).all() else np.zeros((len(q), 1), dtype=np.int64)

    def search(self, queries: np.ndarray, beam: int, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the indexed vectors and similarities, best first; -1 where fewer were found.

        ``own`` are the queries' own rows, if they are indexed: walks begin there.
        """
        ids, sims = [], []
        home = None
        if own is not None:
            home = np.empty(len(self.x), dtype=np.int64)
            home[self.order] = np.arange(len(self.x))
        for k in range(0, len(queries), TOGETHER):
            q = np.ascontiguousarray(queries[k : k + TOGETHER], dtype=np.float32)
            at = np.zeros((len(q), 1), dtype=np.int64)
            if home is not None:
                at = home[own[k : k + TOGETHER]][:, None]
            else:
                for nb in self.layers[:-1]:
                    at = self._walk(nb, q, at, min(4, len(nb)))[0]
            i, s = self._walk(self.layers[-1], q, at, min(beam, len(self.x)))
            ids.append(np.where(i >= 0, self.order[np.maximum(i, 0)], -1))
            sims.append(s)
        return np.concatenate(ids), np.concatenate(sims)

    def within(self, queries: np.ndarray, least: float, beam: int, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, row) found with similarity ``least`` or more.

        A query whose beam is full of them has its beam widened to the whole shard:
        it is compared with every row, many queries at a time. So is every query if
        the beam is as wide as the shard, as a walk may not reach all of it.
        """
        if not len(queries):
            return np.empty(0, int), np.empty(0, int)
        a, b = [], []
        full = np.ones(len(queries), dtype=bool)
        if beam < len(self.x):
            ids, sims = self.search(queries, beam, own)
            full = sims[:, -1] >= least
            r, c = np.nonzero((sims >= least) & ~full[:, None])
            a, b = [r], [ids[r, c]]
        todo = np.flatnonzero(full)
        each = max(1, (1 << 22) // len(self.x))
        for k in range(0, len(todo), each):
            part = todo[k : k + each]
            r, c = np.nonzero(np.asarray(queries[part], dtype=np.float32) @ self.x.T >= least)
            a.append(part[r])
            b.append(c)
        return np.concatenate(a), np.concatenate(b)


def audited_beam(graph: Graph, least: float, goal: float = 0.97, asked: int = 128, start: int = 64, queries: np.ndarray | None = None) -> tuple[int, float]:
    """The narrowest beam, doubling from ``start``, whose recall on spread-out rows reaches ``goal``; and that recall.

    Recall is of the rows with similarity ``least`` or more, as a full comparison of
    the asked rows with all finds them; of the ten nearest where there are no such
    rows. Walks of the indexed rows themselves begin at their own place and do not
    count it; those of ``queries``, which are not indexed, come down from the top.
    """
    n = len(graph.x)
    own = queries is None
    asking = graph.x if own else queries
    rows = np.unique(np.linspace(0, len(asking) - 1, min(len(asking), asked)).astype(int))
    q, home = np.asarray(asking[rows], dtype=np.float32), rows if own else None
    full = q @ graph.x.T
    if own:
        full[np.arange(len(rows)), rows] = -np.inf
    links = set(zip(*(v.tolist() for v in np.nonzero(full >= least)), strict=True))
    near = np.argsort(-full, axis=1)[:, : min(10, n - 1 if own else n)]
    want = links or {(k, int(r)) for k, row in enumerate(near) for r in row}
    beam = start
    while True:
        if links:
            a, b = graph.within(q, least, beam, home)
            got = set(zip(a.tolist(), b.tolist(), strict=True))
        else:
            ids, _ = graph.search(q, beam, home)
            got = {(k, int(r)) for k, row in enumerate(ids) for r in row if r >= 0}
        recall = len(got & want) / max(1, len(want))
        if recall >= goal or beam >= n:
            return beam, recall
        beam *= 2
