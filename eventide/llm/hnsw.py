"""A hierarchical navigable small-world graph over unit vectors, searched for many queries at once."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: links a vector makes; it keeps twice as many on the ground level
LINKS = 12
#: beam while the graph is built
BUILD_BEAM = 48
#: beam on the levels above the one searched; with 4 a group of near vectors is missed as a whole now and then
UPPER_BEAM = 16
_BATCH = 512
#: flags of visited vectors held at a time
_FLAGS = 32 * 2**20
#: products of queries and members held at a time
_PRODUCTS = 4_000_000


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, in double precision (no row may be zero)."""
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _select(own: np.ndarray, cand: np.ndarray, sims: np.ndarray, x: np.ndarray, keep: int) -> np.ndarray:
    """Diverse neighbours: of each row's candidates, nearest first, those nearer to the row than to a neighbour
    taken before; places left go to the nearest of the rest.  -1 marks no candidate; returns (rows, keep)."""
    order = np.argsort(-sims, axis=1, kind="stable")[:, :4 * keep]
    cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
    near = x[cand]
    among = np.einsum("bid,bjd->bij", near, near, optimize=True)
    real = cand >= 0
    taken = np.zeros(cand.shape, bool)
    for j in range(cand.shape[1]):
        rival = np.where(taken, among[:, j, :], -2).max(axis=1)
        taken[:, j] = real[:, j] & (rival < sims[:, j]) & (taken.sum(axis=1) < keep)
    # taken first, then the rest, each nearest first
    rank = np.argsort(np.where(taken, 0, np.where(real, 1, 2)), axis=1, kind="stable")[:, :keep]
    out = np.take_along_axis(cand, rank, 1)
    if out.shape[1] < keep:
        out = np.pad(out, ((0, 0), (0, keep - out.shape[1])), constant_values=-1)
    return out


class Members(Sequence):
    """For each query the members found, ascending where many: as numbers, or as bits where those take less."""

    def __init__(self, size: int, members: int):
        self.members, self.rows = members, [np.empty(0, np.int32)] * size

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, i: int) -> np.ndarray:
        row = self.rows[i]
        return np.flatnonzero(np.unpackbits(row, count=self.members)) if row.dtype == np.uint8 else row

    def put(self, i: int, found: np.ndarray) -> None:
        self.rows[i] = found.astype(np.int32)

    def put_flags(self, i: int, flags: np.ndarray) -> None:
        self.rows[i] = np.packbits(flags) if 32 * flags.sum() > len(flags) else np.flatnonzero(flags).astype(np.int32)


class Hnsw:
    """Levels are lists of members; ``links[l][v]`` are the neighbours of v on level l, -1 where there is none."""

    def __init__(self, x: np.ndarray, levels: list[np.ndarray], links: list[np.ndarray]):
        self.x, self.levels, self.links = x, levels, links

    @classmethod
    def build(cls, x: np.ndarray, seed: int = 11) -> "Hnsw":
        """The graph of the rows of ``x`` (unit vectors, float32), level by level from the top."""
        n = len(x)
        height = np.floor(-np.log(1.0 - np.random.default_rng(seed).random(n)) / np.log(LINKS)).astype(int)
        order = np.argsort(-height, kind="stable")
        top = int(height.max()) if n else 0
        levels = [order[:int((height >= k).sum())] for k in range(top + 1)]
        links = [np.full((n, 2 * LINKS if k == 0 else LINKS), -1, np.int32) for k in range(top + 1)]
        graph = cls(x, levels, links)
        for k in range(top, -1, -1):
            graph._build_level(k)
        return graph

    def ties(self) -> list[bytes]:
        """Each member's links, from the ground level to its highest."""
        out = [row.tobytes() for row in self.links[0]]
        for members, links in zip(self.levels[1:], self.links[1:]):
            for v in members.tolist():
                out[v] += links[v].tobytes()
        return out

    @classmethod
    def tied(cls, x: np.ndarray, ties: list[bytes]) -> "Hnsw":
        """The graph of the rows of ``x`` whose ``ties`` are given."""
        size = np.array([len(t) for t in ties]) // 4
        flat, start, height = np.frombuffer(b"".join(ties), np.int32), np.cumsum(size) - size, size // LINKS - 2
        order, levels, links = np.argsort(-height, kind="stable"), [], []
        for k in range(int(height.max()) + 1):
            levels.append(order[:int((height >= k).sum())])
            first, room = (0, 2 * LINKS) if k == 0 else ((k + 1) * LINKS, LINKS)
            links.append(np.full((len(x), room), -1, np.int32))
            links[k][levels[k]] = flat[start[levels[k]][:, None] + np.arange(first, first + room)]
        return cls(x, levels, links)

    def _build_level(self, k: int) -> None:
        members, at, x = self.levels[k], 0, self.x
        place = np.full(len(x), len(members))
        place[members] = np.arange(len(members))
        while at < len(members):
            size = min(_BATCH, max(32, at), len(members) - at)
            new = members[at:at + size]
            inner = x[new] @ x[new].T
            np.fill_diagonal(inner, -2)
            best = np.argsort(-inner, axis=1, kind="stable")[:, :BUILD_BEAM]
            cand, sims = new[best], np.take_along_axis(inner, best, 1)
            cand = np.where(sims > -2, cand, -1)
            if at:
                entry = self._descend(x[new], k, members[0])
                entry[place[entry] >= at] = members[0]  # a member of the level above that has no links here yet
                got, near = self._beam(x[new], entry, k, BUILD_BEAM)
                cand, sims = np.hstack([cand, got]), np.hstack([sims, near])
            chosen = _select(new, cand, np.where(cand >= 0, sims, -2), x, LINKS)
            self.links[k][new, :LINKS] = chosen
            self._link_back(k, new, chosen)
            at += size

    def _link_back(self, k: int, new: np.ndarray, chosen: np.ndarray) -> None:
        """Neighbours of new members link back, and keep their best links."""
        x, links = self.x, self.links[k]
        room = links.shape[1]
        src, dst = np.repeat(new, chosen.shape[1]), chosen.ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        sims = np.einsum("ad,ad->a", x[src], x[dst])
        order = np.lexsort((-sims, dst))
        src, dst = src[order], dst[order]
        targets, first, count = np.unique(dst, return_index=True, return_counts=True)
        place = np.arange(len(dst)) - np.repeat(first, count)
        nearest = place < room  # of very many only the nearest compete
        more = np.full((len(targets), min(room, int(count.max(initial=0)))), -1, np.int64)
        more[np.repeat(np.arange(len(targets)), count)[nearest], place[nearest]] = src[nearest]
        for lo in range(0, len(targets), _BATCH):
            t = targets[lo:lo + _BATCH]
            both = np.hstack([links[t], more[lo:lo + _BATCH]])
            both = np.sort(both, axis=1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1  # a link made in both directions
            s = np.where(both >= 0, np.einsum("bd,bcd->bc", x[t], x[both]), -2)
            full = (both >= 0).sum(axis=1) > room
            if full.any():
                links[t[full]] = _select(t[full], both[full], s[full], x, room)
            if not full.all():
                rest = ~full
                rank = np.argsort(-s[rest], axis=1, kind="stable")[:, :room]
                links[t[rest]] = np.take_along_axis(both[rest], rank, 1)

    def _descend(self, q: np.ndarray, down_to: int, fallback: int) -> np.ndarray:
        """A near member of the level above ``down_to`` for each query."""
        entry = np.full(len(q), self.levels[-1][0] if len(self.levels) - 1 > down_to else fallback, np.int64)
        for k in range(len(self.levels) - 1, down_to, -1):
            entry = self._beam(q, entry, k, UPPER_BEAM)[0][:, 0]
        return entry

    def _beam(self, q: np.ndarray, entry: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(members, similarities) of the beams of all queries on level k, nearest first; -1 fills up."""
        step = max(1, _FLAGS // max(1, len(self.x)))
        parts = [self._beam_part(q[lo:lo + step], entry[lo:lo + step], k, width) for lo in range(0, len(q), step)]
        return np.vstack([p[0] for p in parts]), np.vstack([p[1] for p in parts])

    def _beam_part(self, q, entry, k, width):
        n, x, links = len(q), self.x, self.links[k]
        ids = np.full((n, width), -1, np.int64)
        sims = np.full((n, width), -2, np.float32)
        fresh = np.zeros((n, width), bool)
        seen = np.zeros((n, len(x)), bool)
        ids[:, 0], sims[:, 0], fresh[:, 0] = entry, np.einsum("ad,ad->a", q, x[entry]), True
        seen[np.arange(n), entry] = True
        live = np.arange(n)
        while len(live):
            s = np.where(fresh[live], sims[live], -3)
            best = s.argmax(axis=1)
            go = s[np.arange(len(live)), best] > -3
            live, best = live[go], best[go]
            if not len(live):
                break
            fresh[live, best] = False
            near = links[ids[live, best]]
            new = (near >= 0) & ~seen[live[:, None], near]
            rows, cols = np.nonzero(new)
            who, what = live[rows], near[rows, cols]
            seen[who, what] = True
            found = np.full(near.shape, -2, np.float32)
            found[rows, cols] = np.einsum("ad,ad->a", q[who], x[what])
            all_ids = np.hstack([ids[live], np.where(new, near, -1)])
            all_sims = np.hstack([sims[live], found])
            all_fresh = np.hstack([fresh[live], new])
            top = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
            ids[live] = np.take_along_axis(all_ids, top, 1)
            sims[live] = np.take_along_axis(all_sims, top, 1)
            fresh[live] = np.take_along_axis(all_fresh, top, 1)
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)

    def within(self, q: np.ndarray, least: float, width: int, widest: int) -> Sequence[np.ndarray]:
        """Members found with similarity ``least`` or more; a beam that is full of such is widened.

        A query that fills a beam of ``widest`` stands in a cluster so dense that
        it is compared with all members, many queries at a time.
        """
        out = Members(len(q), len(self.x))
        todo = np.arange(len(q))
        while len(todo) and width <= widest:
            entry = self._descend(q[todo], 0, self.levels[0][0])
            ids, sims = self._beam(q[todo], entry, 0, min(width, len(self.x)))
            hit = (sims >= least) & (ids >= 0)
            full = hit.all(axis=1) & (width < len(self.x))
            for i in np.flatnonzero(~full):
                out.put(todo[i], ids[i, hit[i]])
            todo, width = todo[full], 2 * width
        step = max(1, _PRODUCTS // max(1, len(self.x)))
        for lo in range(0, len(todo), step):
            part = todo[lo:lo + step]
            near = q[part] @ self.x.T >= least
            for j, i in enumerate(part):
                out.put_flags(i, near[j])
        return out
