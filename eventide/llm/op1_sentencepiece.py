"""SentencePiece encoding by Gumbel top-k sampling without replacement, and decoding.

The segmentations of a text are the paths through its lattice.  A perturbed
A-star search takes the k with the largest Gumbel-perturbed log-probability:
the first is a plain sample; all others share a prefix with it and leave it at
some arc, so each arc opens the set of paths that leave there.  The best perturbed
value in the sets of a sample is a Gumbel at their mass, cut off at the sample's
own, and falls to a set by its part of the mass; the largest value of all holds
the next sample, which is opened in turn.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.lattice import Lattices, Vocabulary, mixed, uniforms, units

#: segmentations of a text
SAMPLES = 2
#: characters whose lattices are sampled together
_TOGETHER = 1_000_000
#: what is left of a whole, as a logarithm, that doubles do not tell from nothing
_NOTHING = 45.0


def vocabulary_of(processor) -> Vocabulary:
    """Text pieces and weights of a SentencePiece model.

    A unigram model's weights are its scores.  The scores of a BPE model are the
    ranks of its merges, 0, -1, ...: there a piece weighs -log(1 + rank).
    """
    n = processor.vocab_size()
    plain = [not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i) or processor.is_unused(i)) for i in range(n)]
    pieces = [processor.id_to_piece(i) if plain[i] else "" for i in range(n)]
    scores = [processor.get_score(i) for i in range(n)]
    ranks = all(s <= 0 and s == int(s) for s, p in zip(scores, plain) if p)
    weights = [-float(np.log1p(-s)) if ranks else s for s in scores]
    by_byte = {processor.id_to_piece(i): i for i in range(n) if processor.is_byte(i)}
    unknown = processor.unk_id()
    return Vocabulary(pieces, weights, [by_byte.get(f"<0x{b:02X}>", unknown) for b in range(256)])


class _Sample:
    """One segmentation, and the masses of the sets of paths that leave it: mass[i] at step ``at + i``.

    ``barred`` are the arcs at step ``at`` that earlier samples took from the
    same node; ``best`` is the largest perturbed value in any of the sets.
    """

    def __init__(self, arcs, log_prob, perturbed, at=0, before=0.0, barred=()):
        self.arcs, self.log_prob, self.perturbed = arcs, log_prob, perturbed
        self.at, self.before, self.barred = at, before, barred
        self.mass, self.best = np.zeros(0), -np.inf


def _cut(mass: float, noise: float, parent: float) -> float:
    """A Gumbel located at log(mass), given that it is not over ``parent``."""
    return -float(np.logaddexp(-parent, -(log(mass) - log(-log(noise))))) if mass > 0 else -np.inf


class Sampler:
    """Samples of texts by one model; lattices of words are kept between texts."""

    def __init__(self, model_file: str):
        import sentencepiece
        self.processor = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.vocabulary = vocabulary_of(self.processor)
        self.lattices = Lattices(self.vocabulary)

    def normalised(self, text: str | None) -> str:
        return self.processor.normalize(text) if text else ""

    def samples(self, texts: list[str], keys: np.ndarray, k: int) -> list[tuple[list[_Sample], float]]:
        """For each normalised text at most k distinct segmentations, and the perturbed value of the next one."""
        la = self.lattices
        words = [units(t) if t else [] for t in texts]
        base, size = la.add([w for ws in words for w in ws])
        n_words = np.array([len(ws) for ws in words], np.int64)
        word_at = np.concatenate([[0], np.cumsum(n_words)])
        place = np.concatenate([[0], np.cumsum(size)])
        place = place[:-1] - np.repeat(place[word_at[:-1]], n_words)
        arcs, counts = la.sample(base, np.repeat(keys, n_words), place, 1)
        step_at = np.concatenate([[0], np.cumsum(counts)])[word_at]
        sums = np.concatenate([[0.0], np.cumsum(la.log[arcs], dtype=np.float64)])[step_at]
        # numbers of a text that belong to no place: of its first value, then four of each further sample
        drawn = [uniforms(keys, np.full(len(keys), i), 0).tolist() for i in range(4 * k)]
        out = []
        for d in range(len(texts)):
            x = _Sample(arcs[step_at[d]:step_at[d + 1]], float(sums[d + 1] - sums[d]), -log(-log(drawn[0][d])))
            self._open(x, drawn[1][d])
            out.append([x])
        for j in range(1, k):
            self._next(out, base, place, word_at, keys, j, [u for u in zip(*drawn[4 * j:4 * j + 4])])
        return [(s, max(x.best for x in s)) for s in out]

    def _open(self, x: _Sample, noise: float) -> None:
        """The masses of the sets that leave ``x`` from step ``x.at`` on.

        They end where what is left of the whole is less than a double can tell.
        """
        la, at, before, parts = self.lattices, x.at, x.before, []
        while at < len(x.arcs) and before > x.before - _NOTHING:
            log_p = la.log[x.arcs[at:at + 64]].astype(np.float64)
            total = before + np.cumsum(log_p)
            parts.append(np.exp(total - log_p) * -np.expm1(log_p))
            at, before = at + len(log_p), float(total[-1])
        if parts:
            x.mass = np.concatenate(parts)
            if x.barred:
                left = self._others(x.arcs[x.at], (*x.barred, int(x.arcs[x.at])))
                x.mass[0] = float(np.exp(x.before + la.log[left].astype(np.float64)).sum())
        x.best = _cut(float(x.mass.sum()), noise, x.perturbed)

    def _others(self, arc: int, barred: tuple[int, ...]) -> np.ndarray:
        """Arcs of the node of ``arc`` that are not barred."""
        first, node = self.lattices.first, self.lattices.origin(arc)
        return np.array([a for a in range(first[node], first[node + 1]) if a not in barred], np.int64)

    def _next(self, out, base, place, word_at, keys, j, drawn) -> None:
        """Add to every text the sample of the open set with the largest value."""
        la, plan, node, key, where = self.lattices, [], [], [], []
        for d, have in enumerate(out):
            x = max(have, key=lambda s: s.best)
            if x.best == -np.inf:
                continue
            value, (u_set, u_arc, noise, _) = x.best, drawn[d]
            run = np.cumsum(x.mass)
            i = min(int(np.searchsorted(run, u_set * run[-1], side="right")), int(np.flatnonzero(x.mass)[-1]))
            t, barred = x.at + i, (*(x.barred if i == 0 else ()), int(x.arcs[x.at + i]))
            others = self._others(x.arcs[t], barred)
            run = np.cumsum(np.exp(la.log[others].astype(np.float64)))
            taken = int(others[min(int(np.searchsorted(run, u_arc * run[-1], side="right")), len(others) - 1)])
            x.mass[i] = 0.0
            x.best = _cut(float(x.mass.sum()), noise, value)
            at = int(la.length[x.arcs[:t]].sum())
            lo, hi = word_at[d], word_at[d + 1]
            word = lo + int(np.searchsorted(place[lo:hi], at, side="right")) - 1
            node.append(np.concatenate([[la.origin(taken) + la.length[taken]], base[word + 1:hi]]))
            where.append(np.concatenate([[at + la.length[taken]], place[word + 1:hi]]))
            key.append(np.repeat(keys[d:d + 1], hi - word))
            plan.append((d, x, t, value, barred, taken, hi - word))
        if not plan:
            return
        steps, counts = la.sample(np.concatenate(node), np.concatenate(key), np.concatenate(where), 1 + j)
        ends = np.cumsum([0] + [p[-1] for p in plan])
        step_at = np.concatenate([[0], np.cumsum(counts)])[ends]
        for q, (d, x, t, value, barred, taken, _) in enumerate(plan):
            arcs = np.concatenate([x.arcs[:t], [taken], steps[step_at[q]:step_at[q + 1]]])
            log_p = la.log[arcs].astype(np.float64)
            y = _Sample(arcs, float(log_p.sum()), value, t, float(log_p[:t].sum()), barred)
            self._open(y, drawn[d][3])
            out[d].append(y)


_samplers: dict[str, Sampler] = {}


def sampler(model_file: str) -> Sampler:
    """The worker's sampler of a model file, kept between tasks."""
    if model_file not in _samplers:
        _samplers[model_file] = Sampler(model_file)
    return _samplers[model_file]


_FIELDS = [("key", pa.int64()), ("row", pa.int64()), ("sample", pa.int32()), ("n_pieces", pa.int64()), ("ids_crc32", pa.int64()),
           ("log_prob", pa.float64()), ("perturbed", pa.float64()), ("inclusion", pa.float64())]
_TABLE = "key long, row long, sample int, n_pieces long, ids_crc32 long, log_prob double, perturbed double, inclusion double"


def _batches(texts: list[str]) -> Iterator[slice]:
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= _TOGETHER:
            yield slice(lo, i + 1)
            lo, size = i + 1, 0
    if lo < len(texts):
        yield slice(lo, len(texts))


def _draw(model_file: str, k: int, seed: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sampler(model_file)
        for batch in batches:
            texts = [own.normalised(t) for t in batch.column("text").to_pylist()]
            ids_of, row_of = batch.column("key"), batch.column("row").to_numpy(zero_copy_only=False)
            keys = mixed(np.array(batch.column("seed_key").to_numpy(zero_copy_only=False)).view(np.uint64) + np.uint64(seed))
            for part in _batches(texts):
                cols = {name: [] for name, _ in _FIELDS}
                took, ids_col = [], []
                for d, (found, beyond) in enumerate(own.samples(texts[part], keys[part], k), part.start):
                    for j, s in enumerate(found):
                        ids = own.lattices.ids(s.arcs)
                        took.append(d)
                        cols["sample"].append(j)
                        cols["n_pieces"].append(len(ids))
                        cols["ids_crc32"].append(zlib.crc32(ids.astype("<u4").tobytes()))
                        cols["log_prob"].append(s.log_prob)
                        cols["perturbed"].append(s.perturbed)
                        cols["inclusion"].append(float(-np.expm1(-np.exp(s.log_prob - beyond))) if beyond > -np.inf else 1.0)
                        if with_ids:
                            ids_col.append(ids.tolist())
                took_at = pa.array(took, pa.int64())
                data = [ids_of.take(took_at), pa.array(row_of[took])] + [pa.array(cols[n], kind) for n, kind in _FIELDS[2:]]
                names = [n for n, _ in _FIELDS]
                if with_ids:
                    data.append(pa.array(ids_col, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(data, names=names)
    return run


def sample_segmentations(docs: DataFrame, model_file: str, k: int = SAMPLES, seed: int = 1, id_col: str = "doc_id",
                         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """At most k rows per row of ``docs``: doc_id, row, sample, n_pieces, ids_crc32, log_prob, perturbed,
    inclusion (and ids).

    The samples of a text are distinct segmentations, by falling perturbed value;
    ``inclusion`` is the probability that a sample's perturbed value is over that
    of the first one left out (1 if none is); ids_crc32 is of the ids as
    little-endian unsigned 32-bit numbers.  Samples depend on the row's id, the seed and the text alone:
    repeated rows have the same, told apart by ``row``; all rows without id are
    seeded alike.  A text with fewer than k segmentations has a row for each;
    null and empty texts have the one empty segmentation.  Texts count whole; an
    empty table gives no rows; other columns are not read.
    """
    key = F.col(id_col).cast("long")
    src = docs.select(key.alias("key"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"),
                      F.xxhash64(F.coalesce(key, F.lit(-1))).alias("seed_key"))
    schema = _TABLE + (", ids array<int>" if with_ids else "")
    return src.mapInArrow(_draw(model_file, k, seed, with_ids), schema).withColumnRenamed("key", "doc_id")


def decode(rows: DataFrame, model_file: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``rows`` with a column of the texts that the ids decode to (null ids: null)."""
    @F.pandas_udf("string")
    def texts(ids: pd.Series) -> pd.Series:
        own = sampler(model_file).processor
        return pd.Series([None if x is None else own.decode([int(i) for i in x]) for x in ids], dtype=object)
    return rows.withColumn(text_col, texts(F.col(ids_col)))
