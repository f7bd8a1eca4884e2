"""Line dedup by a sharded minimal perfect hash over line hashes.

Lines that stand in more than one document are counted by their 128-bit hash.
Each shard of them is a minimal perfect hash that numbers its lines, and arrays
in that order: a fingerprint, the number of documents, the largest document.
Documents come in batches of bounded bytes; the distinct hashes of a batch probe
the arrays of their shards, and only what is to be dropped comes back to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import stage_table
from eventide.llm.perfect_hash import MinimalPerfectHash

#: lines of fewer code points are never dropped
MIN_CHARS = 20
#: documents that a line is found in at least, to be dropped
MIN_DOCS = 3
#: bytes of text of a batch of documents, about
BATCH_BYTES = 4 * 1024 * 1024
#: lines of a shard of the index, about
SHARD_LINES = 262_144
#: bytes of probing hashes that one task gets at once, about
PROBE_BYTES = 32 * 1024 * 1024

_HASH = 16
_SHORT = bytes(_HASH)  # stands for a line that is too short
_SPLIT = "batch long, doc_id long, text string, n_lines long, hashes binary"
_SHARD = "shard long, n long, level_bits array<long>, levels binary, prints binary, docs binary, last binary"


def line_hash(line: bytes) -> bytes:
    """128-bit hash of a line's key: white space stripped at both ends, A-Z in lower case; zero if it is too short."""
    key = line.strip().lower()  # bytes: ASCII white space and letters only
    if len(key) < MIN_CHARS or (len(key) < 4 * MIN_CHARS and not key.isascii() and len(key.decode()) < MIN_CHARS):
        return _SHORT
    return xxhash.xxh3_128_digest(key)


def _split(batch_bytes: int):
    """Rows with their line hashes, in batches; a batch is closed once its texts pass ``batch_bytes``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, 0
        for rows in batches:
            texts = rows.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
            own, n_lines, hashes, start = [], [], [], 0
            for i, text in enumerate(texts):
                got = [line_hash(line) for line in text.split(b"\n")]
                own.append(number)
                n_lines.append(len(got))
                hashes.append(b"".join(got))
                held += len(text)
                last = held >= batch_bytes
                if last or i == len(texts) - 1:
                    part = rows.slice(start, i + 1 - start)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own, pa.int64()), part.column("doc_id"), part.column("text"), pa.array(n_lines, pa.int64()),
                         pa.array(hashes, pa.binary())], names=["batch", "doc_id", "text", "n_lines", "hashes"])
                    own, n_lines, hashes, start = [], [], [], i + 1
                if last:
                    number, held = number + 1, 0
    return run


def _halves(hashes: list[bytes]) -> np.ndarray:
    """(n, 2) signed halves of packed hashes."""
    return np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, doc_id) of the distinct long lines of each document."""
    for rows in batches:
        packed = rows.column("hashes").to_pylist()
        row = np.repeat(np.arange(len(packed)), [len(p) // _HASH for p in packed])
        keys = _halves(packed)
        whole = keys.any(axis=1)
        told = np.unique(np.column_stack([keys[whole], row[whole]]), axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(told[:, 0]), pa.array(told[:, 1]), rows.column("doc_id").take(pa.array(told[:, 2]))], names=["a", "b", "doc_id"])


def line_counts(split: DataFrame) -> DataFrame:
    """(a, b, docs, last): lines that stand in more than one document, in how many, and the largest.

    Counted in two groupings that Spark combines before it shuffles: distinct
    (line, document), then documents of a line.
    """
    held = split.select("doc_id", "hashes").mapInArrow(_held, "a long, b long, doc_id long")
    return held.distinct().groupBy("a", "b").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("last")).filter("docs > 1")


def _index_shard(key: tuple, rows: pa.Table) -> pa.Table:
    a, b = rows["a"].to_numpy().view(np.uint64), rows["b"].to_numpy().view(np.uint64)
    table = MinimalPerfectHash.build(a, b)
    order = np.argsort(table.numbers(a, b))
    docs = np.minimum(rows["docs"].to_numpy(), 255).astype(np.uint8)
    bits, packed = table.dump()
    arrays = [b[order], docs[order], rows["last"].to_numpy()[order]]
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "n": pa.array([table.size], pa.int64()),
                     "level_bits": pa.array([bits], pa.list_(pa.int64())), "levels": pa.array([packed], pa.binary()),
                     **{name: pa.array([x.tobytes()], pa.binary()) for name, x in zip(("prints", "docs", "last"), arrays)}})


def build_index(split: DataFrame, shard_lines: int = SHARD_LINES) -> tuple[DataFrame, int]:
    """The written index, one row per shard, and the number of shards.

    ``prints`` (64 bits), ``docs`` (8 bits, 255 for more) and ``last`` (64 bits)
    stand in the order of the perfect hash.
    """
    counted = stage_table(line_counts(split), "line-counts")
    shards = max(1, -(-counted.count() // shard_lines))
    placed = counted.withColumn("shard", F.pmod("a", F.lit(shards)))
    return stage_table(placed.groupBy("shard").applyInArrow(_index_shard, _SHARD), "line-index"), shards


def _probes(shards: int, slices: int):
    """(shard, slice, batch, hashes): the distinct long lines of a batch, by shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            number = rows.column("batch").to_numpy()
            packed = rows.column("hashes").to_pylist()
            out: dict[str, list] = {"shard": [], "slice": [], "batch": [], "hashes": []}
            for own in np.unique(number):
                keys = _halves([packed[i] for i in np.flatnonzero(number == own)])
                keys = np.unique(keys[keys.any(axis=1)], axis=0)
                shard = np.mod(keys[:, 0], shards)
                order = np.argsort(shard, kind="stable")
                cuts = np.flatnonzero(np.diff(shard[order])) + 1
                for part in np.split(order, cuts) if len(order) else []:
                    out["shard"].append(int(shard[part[0]]))
                    out["slice"].append(int(own % 1_000_003 % slices))
                    out["batch"].append(int(own))
                    out["hashes"].append(np.ascontiguousarray(keys[part]).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out[c], pa.binary() if c == "hashes" else pa.int64()) for c in out], names=list(out))
    return run


def _ask(min_docs: int):
    """(batch, hits): of the probing hashes those in enough documents, each with the largest of these."""
    empty = pa.table({"batch": pa.array([], pa.int64()), "hits": pa.array([], pa.binary())})

    def run(probes: pa.Table, index: pa.Table) -> pa.Table:
        if not len(probes) or not len(index):
            return empty
        shard = index.to_pylist()[0]
        table = MinimalPerfectHash.load(shard["level_bits"], shard["levels"])
        prints, last = np.frombuffer(shard["prints"], "<u8"), np.frombuffer(shard["last"], "<i8")
        docs = np.frombuffer(shard["docs"], np.uint8)
        batch, hits = [], []
        for own, packed in zip(probes["batch"].to_pylist(), probes["hashes"].to_pylist()):
            keys = _halves([packed])
            a, b = np.ascontiguousarray(keys.T).view(np.uint64)
            at = table.numbers(a, b)
            found = np.flatnonzero(at >= 0)
            found = found[(prints[at[found]] == b[found]) & (docs[at[found]] >= min_docs)]
            if len(found):
                batch.append(own)
                hits.append(np.column_stack([keys[found], last[at[found]]]).tobytes())
        return pa.table({"batch": pa.array(batch, pa.int64()), "hits": pa.array(hits, pa.binary())})
    return run


def probe(split: DataFrame, index: DataFrame, shards: int, min_docs: int = MIN_DOCS, probe_bytes: int = PROBE_BYTES) -> DataFrame:
    """(batch, hits) of every batch of documents with lines to drop.

    The probing hashes of a shard are cut into slices of bounded bytes, each of
    which meets a copy of the shard, itself of bounded size.
    """
    lines = split.agg(F.sum("n_lines")).first()[0] or 0
    slices = max(1, -(-lines * _HASH // (shards * probe_bytes)))
    asked = split.select("batch", "hashes").mapInArrow(_probes(shards, slices), "shard long, slice long, batch long, hashes binary")
    copies = index.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))
    return asked.groupBy("shard", "slice").cogroup(copies.groupBy("shard", "slice")).applyInArrow(
        _ask(min_docs), "batch long, hits binary")


def _drop(rows: pa.Table, answers: pa.Table) -> pa.Table:
    found = b"".join(answers["hits"].to_pylist())
    last = {found[k:k + _HASH]: int.from_bytes(found[k + _HASH:k + 24], "little", signed=True) for k in range(0, len(found), 24)}
    texts, dropped = [], []
    ids = rows["doc_id"].to_pylist()
    for doc_id, text, hashes in zip(ids, rows["text"].cast(pa.binary()).to_pylist(), rows["hashes"].to_pylist()):
        lines = (text or b"").split(b"\n")
        # a line stays where no answer names it, or where this is its largest document
        kept = [line for k, line in enumerate(lines) if last.get(hashes[k * _HASH:k * _HASH + _HASH], doc_id) == doc_id]
        texts.append(b"\n".join(kept))
        dropped.append(len(lines) - len(kept))
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_lines": rows["n_lines"], "n_dropped": pa.array(dropped, pa.int64()),
                     "text": pa.array(texts, pa.binary()).cast(pa.string())})


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                shard_lines: int = SHARD_LINES, batch_bytes: int = BATCH_BYTES, probe_bytes: int = PROBE_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, text (the lines that stay).

    Lines whose key has ``MIN_CHARS`` code points and stands in ``min_docs``
    documents (2 at least, 255 at most) are dropped but in the largest doc_id
    that holds it, where all stay.  Null and empty texts are one empty line.
    Rows of one doc_id are one document to the count, rows without doc_id one
    that is smaller than all others; repeated rows come out as often as they are
    in.  Texts count whole, of any length; an empty table gives no rows; other
    columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    split = stage_table(rows.mapInArrow(_split(batch_bytes), _SPLIT), "lines")
    index, shards = build_index(split, shard_lines)
    answers = probe(split, index, shards, min_docs, probe_bytes)
    return split.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        _drop, "doc_id long, n_lines long, n_dropped long, text string")
