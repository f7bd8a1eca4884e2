"""Segmentation lattices of words, built and sampled for many words at once with numpy.

A node is a place in a word, an arc a piece that leads to a later place.  Arcs
carry their conditional probability given the node under the model's weights
(forward sampling by backward sums), so a path's log-probability is the sum of
its arcs' logarithms.
"""

from __future__ import annotations

import re

import numpy as np

#: bounds of a store; a fuller one starts afresh
MAX_NODES, MAX_ARCS = 4_000_000, 9_000_000
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_UNITS = re.compile("▁*[^▁]+|▁+")


def units(normalised: str) -> list[str]:
    """Words of a normalised text, each with the blank before it: no piece spans two of them.

    The blank of a word with just one is left off its name here.
    """
    if normalised[:1] == "▁" and "▁▁" not in normalised and normalised[-1] != "▁":
        return normalised[1:].split("▁")
    return [u[1:] if u[0] == "▁" and len(u) > 1 and u[1] != "▁" else "\n▁" + u for u in _UNITS.findall(normalised)]


def spelled(unit: str) -> str:
    """The characters of a unit as ``units`` names it."""
    return unit[2:] if unit[:2] == "\n▁" else "▁" + unit


def mixed(x: np.ndarray) -> np.ndarray:
    """Well-mixed 64-bit numbers of 64-bit numbers."""
    x = x + _GOLD
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniforms(key: np.ndarray, counter: np.ndarray, stream: int) -> np.ndarray:
    """Uniform numbers in (0, 1) of (key, counter, stream), the same whenever asked."""
    z = mixed(key + counter.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(stream << 40))
    return ((z >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


class Vocabulary:
    """Pieces of a model as a trie in an open-addressed table, with a weight each."""

    def __init__(self, pieces: list[str], weights: list[float], byte_ids: list[int]):
        """``pieces[i]`` is empty where id ``i`` is no text piece; ``byte_ids`` are those of the 256 bytes, or none."""
        self.pieces, self.byte_ids = pieces, np.array(byte_ids, np.int64)
        self.longest = max((len(p) for p in pieces), default=1)
        used = [w for p, w in zip(pieces, weights) if p]
        self.byte_weight = min(used, default=0.0) - 10.0
        node_of: dict[tuple[int, str], int] = {}
        ends, at_end = [-1], [0.0]
        for i, p in enumerate(pieces):
            at = 0
            for c in p:
                if (nxt := node_of.get((at, c))) is None:
                    nxt = node_of[at, c] = len(ends)
                    ends.append(-1)
                    at_end.append(0.0)
                at = nxt
            if p:
                ends[at], at_end[at] = i, weights[i]
        self.ends, self.weight = np.array(ends, np.int64), np.array(at_end)
        bits = max(8, (4 * len(node_of)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.child = np.zeros(1 << bits, np.int64)
        edges = np.array([(at << 21) | ord(c) for at, c in node_of], np.int64)
        for key, slot, to in zip(edges.tolist(), self._slot(edges).tolist(), node_of.values()):
            while self.keys[slot] >= 0:
                slot = (slot + 1) & (len(self.keys) - 1)
            self.keys[slot], self.child[slot] = key, to

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * _GOLD) >> self.shift).astype(np.int64)

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The trie's child of each node by each character, -1 where there is none."""
        key = (node << 21) | char
        slot = self._slot(key)
        out = np.full(len(key), -1, np.int64)
        todo = np.arange(len(key))
        while len(todo):
            seen = self.keys[slot[todo]]
            hit = seen == key[todo]
            out[todo[hit]] = self.child[slot[todo[hit]]]
            todo = todo[~hit & (seen >= 0)]
            slot[todo] = (slot[todo] + 1) & (len(self.keys) - 1)
        return out


class Lattices:
    """Lattices of all words met so far, in flat arrays."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._clear()

    def _clear(self) -> None:
        self.base: dict[str, int] = {}
        self.nodes = self.arcs = 0
        self.first = np.zeros(1, np.int32)     # of a node, its first arc; one more than nodes
        self.length = np.zeros(0, np.int32)    # of an arc, in characters
        self.piece = np.zeros(0, np.int32)     # id; -1 - code point for a character written as bytes
        self.log = np.zeros(0, np.float32)     # logarithm of the conditional probability
        self.cdf = np.zeros(0, np.float32)     # within the node; the last arc's is over 1

    def add(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """First nodes and lengths of the words, after lattices are made for new ones."""
        if self.nodes > MAX_NODES or self.arcs > MAX_ARCS:
            self._clear()
        base = list(map(self.base.get, words))
        if None in base:
            self._build(list({w for w, b in zip(words, base) if b is None}))
            base = list(map(self.base.__getitem__, words))
        at = np.array(base, np.int64)
        return at >> 24, at & 0xFFFFFF

    def _grow(self, name: str, used: int, more: np.ndarray) -> None:
        old = getattr(self, name)
        if used + len(more) > len(old):
            bigger = np.empty(max(3 * len(old) // 2, used + len(more)), old.dtype)
            bigger[:used] = old[:used]
            setattr(self, name, bigger)
            old = bigger
        old[used:used + len(more)] = more

    def _build(self, words: list[str]) -> None:
        """Lattices of new words: arcs by length, then their order by node, then backward sums from the words' ends."""
        v, plain = self.vocabulary, [spelled(w) for w in words]
        sizes = np.array(list(map(len, plain)), np.int64)
        text = np.frombuffer("".join(plain).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        # nodes: a word's characters, then its end
        starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        n = int((sizes + 1).sum())
        char = np.full(n, -1, np.int64)
        inner = np.ones(n, bool)
        inner[starts + sizes] = False
        char[inner] = text
        left = np.repeat(starts + sizes, sizes + 1) - np.arange(n)  # characters to the word's end
        at, node, k = np.flatnonzero(inner), np.zeros(int(inner.sum()), np.int64), 0
        found, has_one = [], np.zeros(n, bool)
        while len(at):
            node = v.step(node, char[at + k])
            go = node >= 0
            at, node = at[go], node[go]
            k += 1
            ident = v.ends[node]
            end = ident >= 0
            if k == 1:
                has_one[at[end]] = True
                bare = np.flatnonzero(inner & ~has_one)  # no piece is this character: its bytes
                found.append((bare, 1, -1 - char[bare], np.full(len(bare), v.byte_weight)))
            found.append((at[end], k, ident[end], v.weight[node[end]]))
            go = left[at] > k
            at, node = at[go], node[go]
        count = sum((np.bincount(f[0], minlength=n) for f in found), np.zeros(n, np.int64))
        # arcs lie by their node's characters left, so that a sum's terms are there before it and together
        by_left = np.argsort(left.astype(np.int32), kind="stable")
        fill = np.empty(n, np.int64)
        fill[by_left] = np.cumsum(count[by_left]) - count[by_left]
        begin = fill.copy()
        total = int(count.sum())
        rows, length, piece, weight = np.empty(total, np.int64), np.empty(total, np.int64), np.empty(total, np.int64), np.empty(total)
        for where, size, ident, w in found:
            place = fill[where]
            fill[where] = place + 1
            rows[place], length[place], piece[place], weight[place] = where, size, ident, w
        back = np.zeros(n)
        longest = int(sizes.max())
        node_at = np.searchsorted(left[by_left], np.arange(longest + 2))
        for d in range(1, longest + 1):
            own = by_left[node_at[d]:node_at[d + 1]]
            lo, hi = begin[own[0]], begin[own[-1]] + count[own[-1]]
            terms = weight[lo:hi] + back[rows[lo:hi] + length[lo:hi]]
            cuts = begin[own] - lo
            top = np.maximum.reduceat(terms, cuts)
            back[own] = top + np.log(np.add.reduceat(np.exp(terms - np.repeat(top, count[own])), cuts))
        log = weight + back[rows + length] - back[rows]
        run = np.cumsum(np.exp(log))
        some = count[rows]
        cdf = run - np.where(begin[rows] > 0, run[begin[rows] - 1], 0.0)
        cdf[np.flatnonzero(np.append(rows[1:] != rows[:-1], True))] = 2.0
        cdf[some == 1] = 2.0
        # back to the order of nodes
        first = np.concatenate([[0], np.cumsum(count)])
        order = np.empty(total, np.int64)
        order[first[rows] + np.arange(total) - begin[rows]] = np.arange(total)
        self._grow("first", self.nodes, first + self.arcs)
        for name, more in (("length", length), ("piece", piece), ("log", np.minimum(log, 0.0)), ("cdf", cdf)):
            self._grow(name, self.arcs, more[order])
        self.base.update(zip(words, ((starts + self.nodes) << 24 | sizes).tolist()))
        self.nodes += n
        self.arcs += total

    def sample(self, node: np.ndarray, key: np.ndarray, place: np.ndarray, stream: int) -> tuple[np.ndarray, np.ndarray]:
        """A path from each node to its word's end: (arcs, path lengths), path after path.

        Drawn by the numbers of (key, place, stream); ``place`` is the node's
        character in the text, so that no number is used twice.
        """
        first, cdf = self.first, self.cdf
        live = np.flatnonzero(first[node + 1] > first[node])
        now, where = node[live], place[live]
        who, arcs = [], []
        while len(live):
            u = uniforms(key[live], where, stream).astype(np.float32)
            arc = first[now]
            todo = np.flatnonzero(cdf[arc] < u)
            while len(todo):
                arc[todo] += 1
                todo = todo[cdf[arc[todo]] < u[todo]]
            who.append(live)
            arcs.append(arc)
            size = self.length[arc]
            now = now + size
            where = where + size
            go = first[now + 1] > first[now]
            live, now, where = live[go], now[go], where[go]
        count = np.zeros(len(node), np.int64)
        for w in who:
            count[w] += 1
        begin = np.cumsum(count) - count
        out = np.empty(int(count.sum()), np.int64)
        for k, (w, a) in enumerate(zip(who, arcs)):
            out[begin[w] + k] = a
        return out, count

    def origin(self, arc: int) -> int:
        """The node an arc leaves."""
        return int(self.first[:self.nodes + 1].searchsorted(np.int32(arc), side="right")) - 1

    def ids(self, path: np.ndarray) -> np.ndarray:
        """Piece ids of arcs; a character without a piece is the ids of its UTF-8 bytes."""
        ids = self.piece[path].astype(np.int64)
        odd = np.flatnonzero(ids < 0)
        if not len(odd):
            return ids
        spelled = [chr(-1 - c).encode("utf-8", "surrogatepass") for c in ids[odd].tolist()]
        width = np.ones(len(ids), np.int64)
        width[odd] = [len(s) for s in spelled]
        out = np.repeat(ids, width)
        out[out < 0] = self.vocabulary.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
        return out
