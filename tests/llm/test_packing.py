"""Packing: ids against the tokenizer itself, bounds and packings against brute force."""
import random
import zlib
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventide.llm import op6_packing as op6
from eventide.llm.common import vocabulary

PATH = vocabulary("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encoder():
    return op6.WordEncoder(PATH)


def direct(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


@settings(max_examples=150, deadline=None)
@given(text=st.text(alphabet=st.sampled_from("abcXYZ éÉßÿ÷µ'’.,!?|<>%&$#*-0123½٣ \n\t\r\x0b\x0c\x1c\x85  Σςİ漢字🙂éﬁ"), max_size=40))
def test_ids_are_the_tokenizers(encoder, text):
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == direct(encoder, text)


def test_special_strings_and_contractions(encoder):
    for text in ("<|endoftext|>", "a<|startoftext|>b", "it's IT'S don't'll 're", "x|y| z||", "a.b.c. d..", None, ""):
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == direct(encoder, text)


def fewest(lengths, capacity):
    best = len(lengths)
    for way in product(range(len(lengths)), repeat=len(lengths)):
        if len(set(way)) < best and all(sum(x for x, w in zip(lengths, way) if w == s) <= capacity for s in set(way)):
            best = len(set(way))
    return best


def test_bound_and_best_fit_around_the_optimum():
    r = random.Random(2)
    for _ in range(60):
        lengths = np.array([r.randint(1, 12) for _ in range(r.randint(1, 5))])
        best = fewest(lengths.tolist(), 12)
        seq, off = op6.best_fit_decreasing(lengths, 12)
        assert op6.lower_bound(lengths, 12) <= best <= seq.max() + 1
    assert op6.lower_bound(np.array([7, 7, 7]), 12) == 3      # no two fit together
    assert op6.lower_bound(np.array([5, 5, 5, 5, 5]), 12) == 3  # two in each, by thirds
    assert op6.lower_bound(np.array([], np.int64), 12) == 0


def check(rows, got, encoder, capacity):
    want = {}
    for i, text in rows:
        ids = direct(encoder, text)
        for k in range(0, len(ids), capacity):
            own = ids[k:k + capacity]
            want.setdefault((i, k // capacity, k, len(own), zlib.crc32(np.array(own, "<u4").tobytes())), []).append(1)
    have = {}
    for r in got:
        have.setdefault((r.doc_id, r.piece, r.start, r.length, r.ids_crc32), []).append(1)
    assert have == want
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert ends.get(r.sequence_id, 0) == r.offset
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values(), default=0) <= capacity
    return len(ends)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 3, 4, "s") for i, t in rows], "doc_id long, text string, rid long, seq long, part string")


def test_pieces_and_sequences(spark, encoder, monkeypatch):
    monkeypatch.setattr(op6, "PART_ROWS", 16)
    r = random.Random(4)
    rows = [(k, " ".join(r.choice("alpha beta, Gamma. the of Ünder 12 x|y".split()) for _ in range(r.choice([0, 1, 5, 20, 60])))) for k in range(90)]
    rows += [(200, None), (201, ""), (None, "no id"), (None, "no id"), (3, rows[3][1]), (202, "word " * 500)]
    got = op6.pack_documents(frame(spark, rows), PATH, capacity=64).collect()
    used = check(rows, got, encoder, 64)
    lengths = np.array([g.length for g in got])
    assert used <= op6.lower_bound(lengths, 64) + 1
    assert op6.pack_documents(frame(spark, []), PATH).collect() == []


def test_exchange_lowers_the_number_of_sequences(spark, monkeypatch):
    monkeypatch.setattr(op6, "PART_ROWS", 8)
    r = random.Random(9)
    rows = [(k, 0, r.randint(1, 40)) for k in range(200)]
    pieces = spark.createDataFrame(rows, "rid long, piece int, length long")
    alone = op6.pack(pieces, capacity=64, rounds=0).select("sequence_id").distinct().count()
    exchanged = op6.pack(pieces, capacity=64).select("sequence_id").distinct().count()
    assert op6.lower_bound(np.array([x[2] for x in rows]), 64) <= exchanged < alone
