"""Ranked lexical search, a term at a time with a limit on accumulators.

Documents become compact postings of the query terms, each task searches blocks
of them: the terms of an item come rarest first, every document that a term is
found in gets an accumulator, and none is made any more once what the remaining
terms can give at most is under the k-th partial score.  From there on only
accumulators that can still reach it are updated, to their exact scores.  Tasks
give their k best, which Spark merges.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventide.llm.common import stage_table

#: documents that an item gets at most
TOP = 10
#: text of the items that are searched in one pass over the documents; more items are further passes
ITEM_BYTES = 8 * 1024 * 1024
#: documents and postings of a block
BLOCK_DOCS, BLOCK_POSTINGS = 16_384, 4_000_000
#: bytes of a text whose words are looked at together
_PIECE = 1 << 20
_ROWS = 512

#: each byte of a text: A-Z in lower case, what stands between terms a blank
_PLAIN = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def words(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, with repeats, in pieces of bounded bytes."""
    raw, at = raw.translate(_PLAIN), 0
    while at < len(raw):
        end = raw.find(b" ", at + _PIECE) if len(raw) - at > _PIECE else -1
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


@dataclass
class Queries:
    """A block of items: their ids, the numbers of their terms (by ``terms``), and how often each term is in its item."""

    item_ids: list[int | None]
    terms: dict[bytes, int]
    numbers: list[np.ndarray]
    repeats: list[np.ndarray]


def query_blocks(items: Iterable[Row], item_bytes: int = ITEM_BYTES) -> Iterator[Queries]:
    """Items (item_id, text) in blocks of bounded bytes."""
    block, held = Queries([], {}, [], []), 0
    for item_id, text in items:
        raw = (text or "").encode()
        own = [block.terms.setdefault(w, len(block.terms)) for piece in words(raw) for w in piece]
        numbers, repeats = np.unique(np.array(own, np.int64), return_counts=True)
        block.item_ids.append(item_id)
        block.numbers.append(numbers)
        block.repeats.append(repeats.astype(np.int64))
        held += len(raw) + 64
        if held >= item_bytes:
            yield block
            block, held = Queries([], {}, [], []), 0
    if block.item_ids:
        yield block


def _index(terms: dict[bytes, int]):
    """(doc_id, n, numbers, counts) of documents with at least one term; numbers and counts only of query terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), _ROWS):
                part = batch.slice(at, _ROWS)
                rows, n, numbers, counts = [], [], [], []
                for i, raw in enumerate(part.column("text").cast(pa.binary()).to_pylist()):
                    total, own = 0, []
                    for piece in words(raw or b""):
                        total += len(piece)
                        own.append(np.array([k for k in map(terms.get, piece) if k is not None], np.int32))
                    if total:
                        found, often = np.unique(np.concatenate(own), return_counts=True)
                        rows.append(i)
                        n.append(total)
                        numbers.append(found.tobytes())
                        counts.append(often.astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()),
                     pa.array(numbers, pa.binary()), pa.array(counts, pa.binary())], names=["doc_id", "n", "numbers", "counts"])
    return run


def _tally(size: int):
    """(term, amount) of a task: documents of each term; as term -1 the documents, as -2 the terms of all of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, total = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            found = np.frombuffer(b"".join(batch.column("numbers").to_pylist()), np.int32)
            held += np.bincount(found, minlength=size)
            n = batch.column("n").to_numpy()
            docs, total = docs + len(n), total + int(n.sum())
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([some, [-1, -2]])), pa.array(np.concatenate([held[some], [docs, total]]))], names=["term", "amount"])
    return run


def _best(score: np.ndarray, doc_id: np.ndarray, no_id: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, equal ones by ascending id, rows without id last."""
    if len(score) > 4 * k:  # only what reaches the k-th score is sorted
        some = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        some = np.arange(len(score))
    return some[np.lexsort((doc_id[some], no_id[some], -score[some]))[:k]]


class Block:
    """Postings of some documents by term: ``docs`` and ``parts`` (what a term adds for each unit of its weight)."""

    def __init__(self, lengths: np.ndarray, numbers: list[bytes], counts: list[bytes], size: int, docs: int, total: int):
        term = np.frombuffer(b"".join(numbers), np.int32)
        often = np.frombuffer(b"".join(counts), np.int32).astype(np.int64)
        doc = np.repeat(np.arange(len(lengths)), [len(x) // 4 for x in numbers])
        m = 100 - 75 + (75 * lengths * docs) // total
        order = np.argsort(term, kind="stable")  # documents of a term ascend
        self.size = len(lengths)
        self.docs = doc[order]
        self.parts = ((1_000_000_000 * often) // (1000 * often + 8 * m[doc]))[order]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=size))])
        self.most = np.zeros(size, np.int64)
        some = np.flatnonzero(np.diff(self.starts))
        if len(some):
            self.most[some] = np.maximum.reduceat(self.parts, self.starts[some])

    def search(self, numbers: np.ndarray, weights: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) that hold the block's k best of an item whose terms come rarest first.

        ``floor``: a score that k other documents have; what cannot reach it may be left out.
        """
        own = self.most[numbers] > 0
        numbers, weights = numbers[own], weights[own]
        most = weights * self.most[numbers]
        rest = np.concatenate([np.cumsum(most[::-1])[::-1], [0]])  # what the terms from here on give at most
        sums = np.zeros(self.size, np.int64)
        at, bar = 0, floor
        while at < len(numbers):
            if rest[0] - rest[at] > rest[at] and self.size > k:  # partial scores may be over the bound by now
                bar = max(bar, int(np.partition(sums, self.size - k)[self.size - k]))
            if rest[at] < bar:
                break
            lo, hi = self.starts[numbers[at]], self.starts[numbers[at] + 1]
            sums[self.docs[lo:hi]] += weights[at] * self.parts[lo:hi]
            at += 1
        docs = np.flatnonzero(sums)
        sums = sums[docs]
        for t in range(at, len(numbers)):  # no new accumulators: update those that can still reach the bar
            if len(docs) > k:
                bar = max(bar, int(np.partition(sums, len(sums) - k)[len(sums) - k]))
            stay = sums + rest[t] >= bar
            docs, sums = docs[stay], sums[stay]
            lo, hi = self.starts[numbers[t]], self.starts[numbers[t] + 1]
            place = np.searchsorted(self.docs[lo:hi], docs)
            found = np.flatnonzero(place < hi - lo)
            found = found[self.docs[lo + place[found]] == docs[found]]
            sums[found] += weights[t] * self.parts[lo + place[found]]
        return docs, sums


def _blocks(batches: Iterator[pa.RecordBatch], block_docs: int) -> Iterator[pa.Table]:
    """Rows in tables of bounded documents and postings."""
    held, rows, postings, step = [], 0, 0, min(_ROWS, block_docs)
    for batch in batches:
        for at in range(0, len(batch), step):
            part = batch.slice(at, step)
            held.append(part)
            rows += len(part)
            postings += sum(len(x) for x in part.column("numbers").to_pylist()) // 4
            if rows >= block_docs or postings >= BLOCK_POSTINGS:
                yield pa.Table.from_batches(held)
                held, rows, postings = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _search(queries: Queries, weights: dict[int, int], docs: int, total: int, k: int, block_docs: int):
    weight = np.zeros(len(queries.terms) + 1, np.int64)
    weight[list(weights)] = list(weights.values())
    asked = []
    for numbers, repeats in zip(queries.numbers, queries.repeats):
        order = np.lexsort((numbers, -weight[numbers]))  # rarest first
        asked.append((numbers[order], (weight[numbers] * repeats)[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        best = [(none, none, none.astype(bool))] * len(asked)  # per item: scores, ids, rows without id
        for rows in _blocks(batches, block_docs):
            block = Block(rows["n"].to_numpy(), rows["numbers"].to_pylist(), rows["counts"].to_pylist(), len(weight), docs, total)
            ids = rows["doc_id"].fill_null(0).to_numpy()
            no_id = rows["doc_id"].is_null().to_numpy()
            for q, (numbers, weights_) in enumerate(asked):
                score, doc_id, lack = best[q]
                found, sums = block.search(numbers, weights_, k, int(score.min()) if len(score) == k else 0)
                both = np.concatenate([score, sums]), np.concatenate([doc_id, ids[found]]), np.concatenate([lack, no_id[found]])
                top = _best(*both, k)
                best[q] = tuple(x[top] for x in both)
        q = np.repeat(np.arange(len(best)), [len(b[0]) for b in best])
        score, doc_id, lack = (np.concatenate([b[j] for b in best]) for j in range(3))
        yield pa.RecordBatch.from_arrays(
            [pa.array(q, pa.int64()), pa.array([queries.item_ids[i] for i in q], pa.int64()), pa.array(doc_id, mask=lack), pa.array(score)],
            names=["q", "item_id", "doc_id", "score"])
    return run


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
           item_text_col: str = "text", k: int = TOP, item_bytes: int = ITEM_BYTES, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every row of ``items``, scores above 0 only.

    Equal scores rank by ascending doc_id, rows without doc_id last.  Null,
    empty and termless texts are no documents, and such items find none.  Each
    row counts as a document or an item of its own, repeated ones too.  Texts
    count whole, of any length; empty tables give no rows; other columns are not
    read.  Items are read in blocks of ``item_bytes``, each searched in a pass
    of its own over all documents.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
    out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in query_blocks(asked.toLocalIterator(), item_bytes):
        out = out.unionByName(_ranked(rows, block, k, block_docs))
    return out


def _ranked(rows: DataFrame, queries: Queries, k: int, block_docs: int) -> DataFrame:
    size = len(queries.terms)
    index = stage_table(rows.mapInArrow(_index(queries.terms), "doc_id long, n long, numbers binary, counts binary"), "postings")
    tallied = index.select("n", "numbers").mapInArrow(_tally(size), "term long, amount long").groupBy("term").agg(
        F.sum("amount").alias("amount")).collect()  # one row per query term of the block at most
    amount = {r["term"]: r["amount"] for r in tallied}
    n, total = amount.pop(-1, 0), amount.pop(-2, 0)
    weights = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for t, df in amount.items()}
    found = index.mapInArrow(_search(queries, weights, n, total, k, block_docs), "q long, item_id long, doc_id long, score long")
    order = W.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
