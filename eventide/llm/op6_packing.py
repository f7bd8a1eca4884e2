"""Bound-certified best-fit packing of tokenised documents into sequences.

Pieces are dealt to parts, each part is packed best-fit decreasing, and a lower
bound from dual-feasible functions certifies its number of sequences.  Parts
with a gap, and the least filled sequences of all parts, exchange their pieces
and are packed again.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import slices, stage_table

CAPACITY = 4096
END_ID = 1
#: pieces that one part packs, about
PART_ROWS = 8192
#: exchanges among parts
ROUNDS = 4
#: bytes of words, stems and ids that a worker remembers, about; beyond, it starts afresh
MEMO_BYTES = 112 * 1024 * 1024
#: of these, what a word and its share of the stems take besides its own letters
_ENTRY = 170
#: bytes of text that are encoded together, about
TOGETHER_BYTES = 512 * 1024
_TAIL = ".,!?;:%&$#*|"
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


class WordEncoder:
    """Ids of whole texts, with the ids of each blank-separated word remembered.

    The tokenizer drops white space and splits at it, so the ids of a text are
    those of its words.  Marks of ``_TAIL`` after a letter are split from it by
    the tokenizer too, so words that differ in them, or in case, share the ids of
    their letters.  Ids are kept as little-endian unsigned 32-bit bytes.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.words: dict[bytes, bytes] = {}
        self.stems: dict[str, bytes] = {}
        self.held = 0

    def _learn_stems(self, stems: list[str]) -> None:
        """Ids of letter runs, encoded as one text: each run ends with its only id that closes a word."""
        ids = np.array(self.tokenizer.encode(" ".join(stems), add_special_tokens=False).ids, "<u4")
        ends = np.flatnonzero(self.closes[ids]) + 1
        for stem, lo, hi in zip(stems, np.concatenate([[0], ends[:-1]]), ends, strict=True):
            self.stems[stem] = ids[lo:hi].tobytes()

    def _learn_others(self, texts: list[str]) -> None:
        for t, e in zip(texts, self.tokenizer.encode_batch(texts, add_special_tokens=False)):
            self.words[t.encode()] = np.array(e.ids, "<u4").tobytes()

    def _learn(self, words: set[bytes]) -> None:
        cut, others, stems = [], set(), set()
        for raw in words:
            w = raw.decode()
            stem = w.rstrip(_TAIL)
            if _LETTERS.fullmatch(stem):
                tail, stem = w[len(stem):], stem.lower()
                cut.append((raw, stem, tail.encode()))
                if stem not in self.stems:
                    stems.add(stem)
                if tail and tail.encode() not in self.words:
                    others.add(tail)
            else:
                others.add(w)
        if stems:
            self._learn_stems(list(stems))
        if others:
            self._learn_others(list(others))
        for raw, stem, tail in cut:
            self.words[raw] = self.stems[stem] + (self.words[tail] if tail else b"")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, ``END_ID`` last."""
        if self.held > MEMO_BYTES:
            self._forget()
        split = [(t or "").encode().split() for t in texts]  # bytes: ASCII white space only
        known = self.words
        new = {w for ws in split for w in ws if w not in known}
        if new:
            self.held += 2 * sum(map(len, new)) + _ENTRY * len(new)
            self._learn(new)
        end = np.array([END_ID], "<u4").tobytes()
        return [b"".join(map(known.__getitem__, ws)) + end for ws in split]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of a vocabulary file, kept between tasks with what it remembers, which is bounded in bytes."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


_PIECES = "doc_id long, rid long, piece int, start long, length long, ids_crc32 long"


def _cut(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            for at, end in slices(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist(), TOGETHER_BYTES):
                part = batch.slice(at, end - at)
                row, piece, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(enc.encode(part.column("text").to_pylist())):
                    for k, lo in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[lo:lo + 4 * capacity]
                        row.append(i)
                        piece.append(k)
                        start.append(lo // 4)
                        length.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                at_rows = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(at_rows), part.column("rid").take(at_rows), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "rid", "piece", "start", "length", "ids_crc32"])
    return run


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of every piece; the fullest sequence with room takes the next longest piece."""
    order = np.argsort(-lengths, kind="stable")
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r: a sequence with room r is open
    seq, off = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    n = 0
    for i, size in zip(order.tolist(), lengths[order].tolist()):
        fits = open_rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            s = by_room[room].pop()
            if not by_room[room]:
                open_rooms &= ~(1 << room)
        else:
            room, s = capacity, n
            n += 1
        seq[i], off[i] = s, capacity - room
        left = room - size
        if left:
            by_room[left].append(s)
            open_rooms |= 1 << left
    return seq, off


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: the best of two families of dual-feasible functions.

    By thresholds t up to half the capacity: a piece longer than ``capacity - t``
    counts as a sequence, one shorter than t as nothing, the rest by its length
    (t = 0: the sum of lengths).  By parts k: a piece counts as many k-ths as it
    has whole (k+1)-ths of the capacity; exact multiples count by their length.
    """
    if not len(lengths):
        return 0
    counts = np.bincount(lengths.astype(np.int64), minlength=capacity + 1)
    sizes = np.arange(capacity + 1)
    number = np.concatenate([[0], np.cumsum(counts)])         # pieces shorter than t
    total = np.concatenate([[0], np.cumsum(counts * sizes)])  # their lengths
    t = np.arange(capacity // 2 + 1)
    long_ = len(lengths) - number[capacity - t + 1]
    middle = total[capacity - t + 1] - total[t]
    best = int((long_ + -(-middle // capacity)).max())
    for k in range(1, 33):
        parts, exact = (k + 1) * sizes // capacity, (k + 1) * sizes % capacity == 0
        # in units of 1 / (k capacity), whole numbers
        worth = int((counts * np.where(exact, k * sizes, parts * capacity)).sum())
        best = max(best, -(-worth // (k * capacity)))
    return best


_PACKED = "part long, rid long, piece int, length long, seq long, off long, certified boolean, open boolean"


def _pack(capacity: int):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "rid", "piece"], ascending=[False, True, True], kind="stable")
        lengths = pdf["length"].to_numpy()
        seq, off = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(seq, weights=lengths).astype(np.int64)
        certified = len(fill) <= lower_bound(lengths, capacity)
        # what may gain by an exchange: all that has room, or the least filled of a certified part
        open_ = (fill < capacity) & ((fill == fill.min()) if certified else True)
        return pd.DataFrame({"part": key[0], "rid": pdf["rid"].to_numpy(), "piece": pdf["piece"].to_numpy(), "length": lengths,
                             "seq": seq, "off": off, "certified": certified, "open": open_[seq]})
    return run


def _packed(pieces: DataFrame, rows: int, round_no: int, capacity: int) -> DataFrame:
    """Pieces dealt to parts by their key's hash and packed part by part; parts of a round have numbers of their own."""
    parts = max(1, -(-rows // PART_ROWS))
    part = F.pmod(F.xxhash64("rid", "piece", F.lit(round_no)), F.lit(parts)) * (ROUNDS + 1) + round_no
    dealt = pieces.select(part.cast("long").alias("part"), "rid", "piece", "length")
    return stage_table(dealt.groupBy("part").applyInPandas(_pack(capacity), _PACKED), "packed")


def _placed(packed: DataFrame) -> DataFrame:
    return packed.select("rid", "piece", (F.col("part") * F.lit(1 << 20) + F.col("seq")).alias("sequence_id"),
                         F.col("off").alias("offset"), "certified")


def _sequences(packed: DataFrame) -> int:
    return packed.filter("off = 0").count()


def pack(pieces: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """(rid, piece, sequence_id, offset, certified) of pieces (rid, piece, length).

    A full sequence stays.  In a part whose number of sequences its lower bound
    does not certify all others are open, in a certified part the least filled.
    Open pieces of all parts are dealt anew and packed again, as long as that
    lowers the number of sequences and more than one part is left.
    """
    whole = F.col("length") == capacity
    out = pieces.filter(whole).select("rid", "piece", (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
                                      F.lit(0).cast("long").alias("offset"), F.lit(True).alias("certified"))
    left = pieces.filter(~whole).select("rid", "piece", "length")
    rows = left.count()
    now = _packed(left, rows, 0, capacity)
    for k in range(1, rounds + 1):
        if rows <= PART_ROWS:  # one part: nothing to exchange with
            break
        left = now.filter("open").select("rid", "piece", "length")
        rows = left.count()
        again = _packed(left, rows, k, capacity)
        if _sequences(again) >= _sequences(now.filter("open")):
            break
        out = out.unionByName(_placed(now.filter("not open")))
        now = again
    return out.unionByName(_placed(now))


def pack_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, certified.

    A document is its ids by the tokenizer of the file ``vocabulary`` and then
    id 1; documents longer than ``capacity`` are cut into pieces of it, the last
    may be shorter.  Null and empty texts are the one id 1.  Rows without doc_id
    and repeated rows are packed each as a document of its own; an empty table
    gives no rows; other columns are not read.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                      F.monotonically_increasing_id().alias("rid"))
    pieces = stage_table(src.mapInArrow(_cut(vocabulary, capacity), _PIECES), "pieces")
    placed = pack(pieces.select("rid", "piece", "length"), capacity)
    return pieces.join(placed, ["rid", "piece"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified")
