"""Near-dedup of embeddings: an HNSW graph per shard, every shard asked for every vector.

Beams widen until an audit against brute force finds all but a few links of a
sample; links are verified by cosine in double precision.  A task counts its
vectors' links and passes on a spanning forest of them, not the links.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import drop_staged, stage_table
from eventide.llm.components import connected_components
from eventide.llm.hnsw import Hnsw, unit

COSINE = 0.9
#: shards; more if a shard's vectors would take more bytes in double precision than the bound
SHARDS, SHARD_BYTES = 8, 64 * 2**20
#: vectors asked at once
BLOCK_ROWS = 8192
#: tasks that ask, about; each has a copy of its shard and asks so many vectors of it at most, about
TASKS, LANE_ROWS = 32, 262_144
#: first beam of a query
BEAM = 48
#: a query that fills a beam so many times as wide is compared with the whole shard
WIDEST = 8
#: audited queries: of all, and of those with links; and the part of their links that must be found
AUDIT, RECALL = 384, 0.999
#: below the threshold by so much a similarity in single precision is verified in double
_SLACK = 1e-3


def _usable(vec):
    """Not null, no null or non-finite component, not zero."""
    sound = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vec) > 0) & sound & F.exists(vec, lambda x: x != 0), F.lit(False))


def _vectors(col: pa.Array, dim: int) -> np.ndarray:
    """The vectors of one length as rows."""
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _build(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """The graph of one shard: a row for each member, with its place and its links as bytes."""
    rows, dim = rows.combine_chunks(), key[0].as_py()
    x = [unit(_vectors(b["vec"], dim).astype(float)).astype(np.float32) for b in rows.to_batches(max_chunksize=BLOCK_ROWS)]
    graph = Hnsw.build(np.concatenate(x))
    told = rows.append_column("place", pa.array(np.arange(len(rows), dtype=np.int32))).append_column("ties", pa.array(graph.ties(), pa.binary()))
    return pa.Table.from_batches(told.select(["dim", "shard", "cid", "vec", "w", "place", "ties"]).to_batches(max_chunksize=BLOCK_ROWS))


class _Forest:
    """Links that join what no link before them has joined."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, v: int) -> int:
        up = self.up
        while (w := up.setdefault(v, v)) != v:
            up[v] = v = up.setdefault(w, w)
        return v

    def joins(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def audited_links(graph: Hnsw, q: np.ndarray, least: float, seed: int = 5) -> Sequence[np.ndarray]:
    """Members near each query, by beams wide enough that the audit passes.

    The audit is the mean, over audited queries that have links, of the share of
    each one's links that was found: a query with two links counts as much as
    one with thousands.
    """
    rng, q32 = np.random.default_rng(seed), q.astype(np.float32)
    width = BEAM
    while True:
        found = graph.within(q32, least - _SLACK, width, WIDEST * width)
        some = np.array([i for i, f in enumerate(found) if len(f) > 1], np.int64)
        sample = np.unique(np.concatenate([rng.permutation(len(q))[:AUDIT], rng.permutation(some)[:AUDIT]]))
        shares = []
        for lo in range(0, len(sample), 64):
            part = sample[lo:lo + 64]
            truth = q32[part] @ graph.x.T >= least
            shares += [truth[j, found[i]].sum() / n for j, i in enumerate(part) if (n := truth[j].sum())]
        passed = not shares or float(np.mean(shares)) >= RECALL
        if passed or width >= len(graph.x):
            break
        width *= 2
    if not passed:  # no beam is wider: the shard is compared whole
        found = graph.within(q32, least - _SLACK, 1, 0)
    return found


class _Shard:
    """Members of one shard and their graph, from rows in order of their places."""

    def __init__(self, rows: list[pa.RecordBatch], dim: int):
        self.cid = np.concatenate([r["cid"].to_numpy() for r in rows])
        self.weight = np.concatenate([r["w"].to_numpy() for r in rows])
        self.exact, at = np.empty((len(self.cid), dim)), 0
        for r in rows:
            self.exact[at:at + len(r)] = unit(_vectors(r["vec"], dim).astype(float))
            at += len(r)
        self.graph = Hnsw.tied(self.exact.astype(np.float32), [t for r in rows for t in r["ties"].to_pylist()])

    def links(self, queries: pa.RecordBatch, least: float) -> pa.RecordBatch:
        """How many links each query has here, and a forest of them."""
        own = queries["cid"].to_numpy()
        q = unit(_vectors(queries["vec"], self.exact.shape[1]).astype(float))
        count, forest, a, b = np.zeros(len(own), np.int64), _Forest(), [], []
        for i, near in enumerate(audited_links(self.graph, q, least)):
            near = near[(self.exact[near] @ q[i] >= least) & (self.cid[near] != own[i])]
            count[i] = self.weight[near].sum()
            for other in self.cid[near].tolist():
                if forest.joins(int(own[i]), other):
                    a.append(int(own[i]))
                    b.append(other)
        return pa.record_batch({"a": np.concatenate([own, np.array(a, np.int64)]),
                                "b": pa.array([None] * len(own) + b, pa.int64()),
                                "links": np.concatenate([count, np.zeros(len(a), np.int64)])})


def _lanes(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Runs of rows of the same length, shard and lane."""
    keys = [batch[c].to_numpy() for c in ("dim", "shard", "lane")]
    cuts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
        if lo < hi:
            yield tuple(int(k[lo]) for k in keys), batch.slice(lo, hi - lo)


def _ask(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, told, shard = None, [], None
        for batch in batches:
            for key, rows in _lanes(batch):
                if key != at:
                    at, told, shard = key, [], None
                members = len(rows) - rows["ties"].null_count  # they come before the queries
                if members:
                    told.append(rows.slice(0, members))
                if members == len(rows) or not (told or shard):
                    continue
                if shard is None:
                    shard, told = _Shard(told, key[0]), []
                asked = rows.slice(members)
                size = -(-len(asked) // -(-len(asked) // BLOCK_ROWS))
                for lo in range(0, len(asked), size):
                    yield shard.links(asked.slice(lo, size), least)
    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE,
                 shards: int = SHARDS) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Rows link where the cosine is at least ``cosine``; component_id is the
    smallest id reachable, kept where it is the row's own.  A vector that is
    null, empty, zero or holds a null or non-finite component links with nothing,
    and so does a row without id (component_id null, kept) and vectors of
    different lengths.  Equal vectors are one point of the graph and link with
    each other; repeated rows count each as a vector.  An empty table gives no
    rows; other columns are not read.
    """
    single = isinstance(getattr(vectors.schema[vec_col].dataType, "elementType", None), T.FloatType)
    kind = "array<float>" if single else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast(kind).alias("vec"))
    sound = rows.filter(_usable(F.col("vec")) & F.col("vec_id").isNotNull())
    points = stage_table(sound.groupBy("vec").agg(F.count(F.lit(1)).alias("w"), F.min("vec_id").alias("least"))
                         .withColumn("cid", F.monotonically_increasing_id()), "points")
    n, numbers = points.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("vec")), F.lit(0))).first()
    shards = max(shards, -(-8 * numbers // SHARD_BYTES))
    lanes = max(1, min(-(-n // BLOCK_ROWS), -(-TASKS // shards)), -(-n // LANE_ROWS))
    at = points.select(F.size("vec").alias("dim"), F.pmod(F.xxhash64("cid"), F.lit(shards)).alias("shard"), "cid", "vec", "w")
    index = stage_table(at.groupBy("dim", "shard").applyInArrow(
        _build, f"dim int, shard long, cid long, vec {kind}, w long, place int, ties binary"), "index")
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    asked = at.select("dim", every(shards).alias("shard"), F.pmod(F.xxhash64("cid", F.lit("block")), F.lit(lanes)).alias("lane"), "cid", "vec")
    told = index.withColumn("lane", every(lanes))
    # a task reads a shard's members by their places and then, a block at a time, the vectors of its lane
    laid = told.unionByName(asked, allowMissingColumns=True).repartitionById(
        shards * lanes, (F.col("shard") * lanes + F.col("lane")).cast("int")).sortWithinPartitions(
        "dim", "shard", "lane", F.col("place").asc_nulls_last(), "cid")
    found = stage_table(laid.mapInArrow(_ask(cosine), "a long, b long, links long"), "found")
    drop_staged(index)

    count = found.groupBy("a").agg(F.sum("links").alias("links"))
    comps = connected_components(found.filter("b is not null").select("a", "b"))
    named = points.select("cid", "vec", "w", "least").join(comps, F.col("cid") == F.col("node"), "left").select(
        "cid", "vec", "w", "least", F.coalesce("comp", "cid").alias("comp"))
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = stage_table(named.join(least, "comp").join(count, F.col("cid") == F.col("a"), "left").select(
        F.col("vec").alias("point"), (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"), "component_id"), "named")
    joined = rows.join(named, (F.col("vec") == F.col("point")) & F.col("vec_id").isNotNull(), "left")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
