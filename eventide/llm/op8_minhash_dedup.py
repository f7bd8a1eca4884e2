"""Near-dedup of documents by MinHash, banding, verification and connected components.

One vertex stands for all documents of one shingle set.  Its signature is the
minima of many universal hashes; bands of it are bucket keys, and the lowest
bit of each minimum makes a sketch that verifies candidates before the full
sets do.  Large buckets are not paired out: members are compared with a leader
first, and only members that no verified link has joined to the rest are
compared with all, block against block, inside tasks that emit just the links.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import drop_staged, slices, spare_name, stage_table
from eventide.llm.components import connected_components
from eventide.llm.words import WordHashes, common, shingle_set

#: 40 bands of 5 minima: a pair at 0.8 meets in no band with probability 1.3e-7
BANDS, ROWS = 40, 5
#: percent of the union that the intersection has at least
PERCENT = 80
#: sketch bits that may differ: 5 standard deviations above the mean at 0.8 (1 bit each of 200 minima), 3e-7 differ in more
SKETCH_SLACK = 5.0
#: vertices of a block on either side, and block rows of a task, about
REST_BLOCK, ALL_BLOCK, TASK_ROWS = 256, 1024, 2048
#: the same in bytes of text, where that makes more blocks or tasks (a longer text is a block of its own)
REST_BYTES, ALL_BYTES, TASK_BYTES = 1 << 20, 4 << 20, 8 << 20
#: bytes of text that are signed together, about
SIGN_BYTES = 1 << 20
_SIGNED = "doc_id long, n_shingles long, digest binary, keys array<long>, bits array<long>"
#: shingles hashed at a time, so that the numbers stay in the cache
_CHUNK = 16_384


def hash_family(n: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and addends of ``n`` universal hashes x -> a x + b mod 2^64, of which the high bits count."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 2**63, n, dtype=np.uint64)


def minima(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrix (sets, hashes) of 32-bit minima; no set may be empty."""
    out = np.full((len(sets), len(a)), np.iinfo(np.uint64).max, np.uint64)
    ends = np.cumsum([len(s) for s in sets])
    every = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    for lo in range(0, len(every), _CHUNK):
        x = every[lo:lo + _CHUNK]
        first = int(np.searchsorted(ends, lo, side="right"))
        last = int(np.searchsorted(ends, lo + len(x) - 1, side="right"))
        starts = np.concatenate([[0], ends[first:last] - lo]).astype(np.int64)
        y = np.empty_like(x)
        for k in range(len(a)):
            np.multiply(x, a[k], out=y)
            y += b[k]
            got = np.minimum.reduceat(y, starts)
            np.minimum(out[first:last + 1, k], got, out=out[first:last + 1, k])
    return out >> np.uint64(32)


def _band_keys(m: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """64-bit key of every band of every row of minima, the band's number mixed in."""
    key = np.zeros((len(m), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(rows):
        key = (key ^ m[:, r::rows][:, :bands]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(31)
    return key


def _sketch(m: np.ndarray) -> np.ndarray:
    """Lowest bits of the minima, 64 to a word."""
    bits = (m & np.uint64(1)).astype(np.uint8)
    pad = -bits.shape[1] % 64
    return np.packbits(np.pad(bits, ((0, 0), (0, pad))), axis=1).view(">u8").astype(np.uint64)


def _sign(width: int, bands: int, rows: int):
    a, b = hash_family(bands * rows)

    def lists(numbers: np.ndarray, full: list[int], n: int) -> pa.Array:
        """Row ``j`` of ``numbers`` as the list at place ``full[j]`` of ``n``; null elsewhere."""
        sizes = np.zeros(n, np.int64)
        sizes[full] = numbers.shape[1]
        flat = pa.array(numbers.view(np.int64).ravel())
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), flat,
                                        mask=pa.array(sizes == 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            for lo, hi in slices(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist(), SIGN_BYTES):
                part = batch.slice(lo, hi - lo)
                sets = [shingle_set(t, width, words) for t in part.column("text").to_pylist()]
                full = [i for i, s in enumerate(sets) if len(s)]
                m = minima([sets[i] for i in full], a, b)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                    lists(_band_keys(m, bands, rows), full, len(sets)), lists(_sketch(m), full, len(sets))],
                    names=["doc_id", "n_shingles", "digest", "keys", "bits"])
    return run


def _verify(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, last, last_set = WordHashes(), None, None
        for batch in batches:
            ok = np.zeros(len(batch), bool)
            ta, tb = batch.column("ta"), batch.column("tb")  # one text at a time becomes a Python string
            for i, a in enumerate(batch.column("a").to_pylist()):
                if a != last:
                    last, last_set = a, shingle_set(ta[i].as_py(), width, words)
                other = shingle_set(tb[i].as_py(), width, words)
                both = common(last_set, other)
                ok[i] = 100 * both >= percent * (len(last_set) + len(other) - both)
            yield batch.select(["a", "b"]).filter(pa.array(ok))
    return run


def _apart(percent: int, bits: int) -> int:
    """Sketch bits in which a pair of the similarity may differ."""
    p = percent / 100
    return int(bits * (1 - p) / 2 + SKETCH_SLACK * (bits * (1 - p) / 2 * (1 + p) / 2) ** 0.5)


def _close(x: str, y: str, percent: int, bits: int) -> "F.Column":
    """Sizes that allow the similarity, and sketches near enough for it."""
    words = -(-bits // 64)
    differ = reduce(lambda s, t: s + t, [F.bit_count(F.expr(f"{x}.bits[{k}] ^ {y}.bits[{k}]")) for k in range(words)])
    return ((F.col(f"{x}.n") * 100 >= F.col(f"{y}.n") * percent) & (F.col(f"{y}.n") * 100 >= F.col(f"{x}.n") * percent)
            & (differ <= _apart(percent, bits)))


def _linked(own: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the other sets reach the similarity with ``own``."""
    every = np.concatenate(others)
    hit = own[np.minimum(np.searchsorted(own, every), len(own) - 1)] == every
    sizes = np.array([len(o) for o in others])
    both = np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes) - sizes)
    return 100 * both >= percent * (len(own) + sizes - both)


def _compare(width: int, percent: int, bits: int):
    """Links between the vertices of a block that are not joined yet and those of another block.

    Of one component a vertex needs a single link: nearest sketches are verified
    first, and what a link has joined is not looked at again.
    """
    apart = _apart(percent, bits)

    def run(table: pa.Table) -> pa.Table:
        words, sets = WordHashes(), {}
        for v, t in zip(table["vid"].to_pylist(), table["text"]):
            if v not in sets:
                sets[v] = shingle_set(t.as_py(), width, words)
        pdf = table.drop_columns(["text"]).to_pandas()
        a, b = [], []
        for _, unit in pdf.groupby(["main", "zb", "xb"], sort=False):
            z, x = unit[unit["rest"]], unit[~unit["rest"]]
            if not len(z) or not len(x):
                continue
            xb = np.stack(x["bits"].to_numpy()).view(np.uint64)
            xv, xn, xc = x["vid"].to_numpy(), x["n"].to_numpy(), x["comp"].to_numpy()
            for v, n, c, own in zip(z["vid"], z["n"], z["comp"], z["bits"]):
                differ = np.bitwise_count(xb ^ np.asarray(own).view(np.uint64)).sum(axis=1)
                go = np.flatnonzero((differ <= apart) & (xc != c) & (xn * 100 >= n * percent) & (xn * percent <= n * 100))
                go, step = go[np.argsort(differ[go], kind="stable")], 8
                while len(go):
                    now, go = go[:step], go[step:]
                    found = now[_linked(sets[v], [sets[w] for w in xv[now]], percent)]
                    for comp, w in {xc[i]: xv[i] for i in found}.items():
                        a.append(v)
                        b.append(w)
                        go = go[xc[go] != comp]
                    step = 512
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


class _Candidates:
    """Verified links among the vertices (vid, doc_id, digest, n, keys, bits), found bucket by bucket."""

    def __init__(self, vertices: DataFrame, src: DataFrame, width: int, percent: int, bits: int):
        self.width, self.percent, self.bits = width, percent, bits
        self.links: list[DataFrame] = []
        keyed = vertices.select("vid", F.explode("keys").alias("key"))
        shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("key")
        self.members = stage_table(keyed.join(shared, "key").select("key", "vid"), "members")
        self.info = vertices.select("vid", "n", "bits")
        self.texts = self._fetch(vertices.select("vid", "doc_id", "digest"), src)

    def _fetch(self, vertices: DataFrame, src: DataFrame) -> DataFrame:
        """(vid, text) of the vertices that share a bucket; an id that is repeated with other texts is told by its set."""
        asked = vertices.join(self.members.select("vid").distinct(), "vid", "left_semi")
        # not deterministic: else Spark runs it on all texts, before the join
        digest = F.pandas_udf(_digests(self.width), "binary").asNondeterministic()
        found = src.join(asked, "doc_id").withColumn("own", digest("text")).filter("own = digest")
        text = found.groupBy("doc_id", "vid").agg(F.first("text").alias("text"))
        return stage_table(text.select("vid", "text", F.octet_length("text").cast("long").alias("size")), "texts")

    def _test(self, pairs: DataFrame) -> None:
        """Verify pairs (a, b) on their full sets."""
        pairs = stage_table(pairs, "pairs")
        left = self.texts.select(F.col("vid").alias("a"), F.col("text").alias("ta"))
        right = self.texts.select(F.col("vid").alias("b"), F.col("text").alias("tb"))
        whole = pairs.join(right, "b").join(left, "a").select("a", "ta", "b", "tb")
        self.links.append(stage_table(whole.mapInArrow(_verify(self.width, self.percent), "a long, b long"), "links"))

    def components(self) -> DataFrame:
        """(node, comp) of the vertices that have links so far."""
        return connected_components(reduce(DataFrame.unionByName, self.links))

    def _open(self, comps: DataFrame) -> DataFrame:
        """Members (key, vid, comp, main) of buckets with more than one component; main is the largest of these."""
        m = self.members.join(comps, F.col("vid") == F.col("node"), "left").select(
            "key", "vid", F.coalesce("comp", "vid").alias("comp"))
        sizes = m.groupBy("key", "comp").count()
        more = sizes.groupBy("key").agg(F.max(F.struct("count", "comp")).alias("m"), F.count(F.lit(1)).alias("c"))
        return stage_table(m.join(more.filter("c > 1").select("key", F.col("m.comp").alias("main")), "key"), "open")

    def _pairs(self, leaders: DataFrame, others: DataFrame) -> DataFrame:
        """Pairs of a bucket's leader and others of other components, if sizes and sketches allow."""
        x = leaders.select("key", F.col("vid").alias("v"), F.col("comp").alias("cv"))
        y = others.select("key", F.col("vid").alias("w"), F.col("comp").alias("cw"))
        pairs = x.join(y, "key").filter("cv <> cw").select(
            F.least("v", "w").alias("a"), F.greatest("v", "w").alias("b")).distinct()
        side = lambda name, vid: self.info.select(F.col("vid").alias(vid), F.struct("n", "bits").alias(name))
        return (pairs.join(side("x", "a"), "a").join(side("y", "b"), "b")
                .filter(_close("x", "y", self.percent, self.bits)).select("a", "b"))

    def _compare_rest(self, now: DataFrame) -> None:
        """Compare what is not joined to its buckets' main component with all that shares such a bucket.

        Both sides of a main component are cut into blocks, by vertices and by
        bytes of text; a task gets some pairs of blocks, with their texts.
        """
        sides = stage_table(now.groupBy("main", "vid").agg(F.max("comp").alias("comp"))
                            .withColumn("rest", F.col("comp") != F.col("main")).join(self.texts.select("vid", "size"), "vid"), "sides")
        cut = lambda rows, size, by_rows, by_bytes: F.greatest(
            F.ceil(rows / by_rows), F.ceil(F.coalesce(size, F.lit(0)) / by_bytes)).cast("long")
        blocks = sides.groupBy("main").agg(
            cut(F.count_if("rest"), F.sum(F.when(F.col("rest"), F.col("size"))), REST_BLOCK, REST_BYTES).alias("zn"),
            cut(F.count(F.lit(1)), F.sum("size"), ALL_BLOCK, ALL_BYTES).alias("xn"))
        told = sides.join(blocks, "main")
        own = lambda n: F.pmod(F.xxhash64("vid"), F.col(n))
        each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        z = told.filter("rest").select("main", "vid", "comp", "rest", "size", own("zn").alias("zb"), each("xn").alias("xb"))
        x = told.select("main", "vid", "comp", F.lit(False).alias("rest"), "size", each("zn").alias("zb"), own("xn").alias("xb"))
        rows = stage_table(z.unionByName(x), "blocks")
        n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
        tasks = max(1, -(-n // TASK_ROWS), -(-size // TASK_BYTES))
        whole = (rows.drop("size").join(self.info, "vid").join(self.texts.select("vid", "text"), "vid")
                 .withColumn("task", F.pmod(F.xxhash64("main", "zb", "xb"), F.lit(tasks))))
        found = whole.groupBy("task").applyInArrow(_compare(self.width, self.percent, self.bits), "a long, b long")
        self.links.append(stage_table(found, "links"))

    def run(self) -> DataFrame:
        """(node, comp) after every candidate pair is verified or already in one component."""
        first = self.members.withColumn("comp", F.col("vid"))
        self._test(self._pairs(first.groupBy("key").agg(F.min("vid").alias("vid")).withColumn("comp", F.col("vid")), first))
        now = self._open(self.components())
        # a leader of the main component, another one in each bucket
        lead = now.filter("comp = main").groupBy("key", "comp").agg(F.min(F.struct(F.xxhash64("vid", "key"), "vid")).alias("l"))
        self._test(self._pairs(lead.select("key", "l.vid", "comp"), now.filter("comp <> main")))
        drop_staged(now)
        now = self._open(self.components())
        self._compare_rest(now)
        drop_staged(now)
        return self.components()


def _digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _digests(width: int):
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = WordHashes()
        for texts in parts:
            sets = (shingle_set(t, width, words) for t in texts)
            yield pd.Series([_digest(s) if len(s) else None for s in sets], dtype=object)
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents link where 100 * intersection >= ``percent`` * union of their
    shingle sets; component_id is the smallest doc_id reachable, kept where it
    is the row's own.  Null, empty and wordless texts have no shingle and link
    with nothing; fewer than ``width`` words are one shingle.  A row without
    doc_id links with nothing: its component_id is null and it is kept.
    Repeated rows are kept or dropped together; one id with different texts has
    a row for each; texts count whole; an empty table gives no rows; other
    columns are not read.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = stage_table(src.mapInArrow(_sign(width, bands, rows), _SIGNED), "signed")
    vertices = signed.filter("digest is not null and doc_id is not null").groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"), F.first("bits").alias("bits"))
    vertices = stage_table(vertices.withColumn("vid", F.monotonically_increasing_id()), "vertices")
    comps = _Candidates(vertices, src, width, percent, bands * rows).run()
    named = vertices.select("vid", "digest", "doc_id").join(comps, F.col("vid") == F.col("node"), "left").select(
        "digest", "doc_id", F.coalesce("comp", "vid").alias("comp"))
    least = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "comp").select(F.col("digest").alias("set"), "component_id")
    out = signed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("set"))
    return out.join(named, "set", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near-duplicates (the one of smallest id), all columns as they came."""
    spare = spare_name(docs, "op8_id")
    gone = near_duplicates(docs, id_col, text_col).filter("not kept and doc_id is not null").select(F.col("doc_id").alias(spare))
    return docs.join(gone.distinct(), F.col(id_col) == F.col(spare), "left_anti")
