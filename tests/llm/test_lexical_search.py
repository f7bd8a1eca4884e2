"""Ranked lexical search against scores of all documents."""
import math
import random
from collections import Counter

import numpy as np
import pytest
import regex

from eventide.llm import op13_lexical_search as op

TERM = regex.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    own = [(i, Counter(terms(t))) for i, t in docs]
    own = [(i, c, sum(c.values())) for i, c in own if c]
    n, total = len(own), sum(x for _, _, x in own)
    df = Counter(t for _, c, _ in own for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, size in own:
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * (25 + 75 * size * n // total))) for t in terms(text) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, rank + 1, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def check(spark, docs, items, **sizes):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in op.search(d, q, **sizes).collect()), key=repr)
    assert got == brute(docs, items, sizes.get("k", 10))
    return got


@pytest.mark.parametrize("sizes", [{}, {"block_docs": 40, "k": 3}, {"item_bytes": 150}])
def test_brute_force(spark, sizes):
    """Rare and frequent terms, copies that tie, small blocks and many passes."""
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(300)]
    draw = lambda n: " ".join(vocabulary[min(int(rng.expovariate(0.03)), 299)] for _ in range(n))
    docs = [(i, draw(rng.randint(1, 60))) for i in range(400)]
    docs += [(1000 + i, docs[i % 5][1].upper()) for i in range(60)]
    items = [(i, draw(rng.randint(1, 25))) for i in range(12)]
    assert len(check(spark, docs, items, **sizes)) == 12 * sizes.get("k", 10)


def test_accumulators_are_limited():
    """No accumulator is made for a document of frequent terms alone, once ten documents hold the rare ones; scores stay exact."""
    lengths = np.full(1000, 10)
    numbers = [np.array([0, 1] if i < 20 else [1], np.int32).tobytes() for i in range(1000)]
    counts = [np.ones(len(x) // 4, np.int32).tobytes() for x in numbers]
    block = op.Block(lengths, numbers, counts, 2, 1000, 10_000)
    docs, sums = block.search(np.array([0, 1]), np.array([9000, 10]), 10, 0)
    assert list(docs) == list(range(20)) and set(sums) == {9010 * (1_000_000_000 // 1800)}
    docs, _ = block.search(np.array([0, 1]), np.array([10, 9]), 30, 0)  # fewer hold the rare one than are asked for
    assert len(docs) == 1000


def test_edges(spark):
    """Nulls, no terms, letters of other scripts, ties, repeated rows and ids, long texts, items that find nothing."""
    docs = [(1, None), (2, ""), (3, "?! -"), (4, "Straße ÉTÉ"), (5, "straße été"), (5, "straße"), (None, "straße"), (7, "straße"),
            (7, "straße"), (8, "a1 b_c [d]"), (9, "x " * 600_000 + "needle"), (10, "x" * 1_500_000 + " needle")]
    items = [(1, "STRASSE straße"), (2, None), (3, "..."), (4, "absent"), (5, "needle needle x"), (None, "B c D A1"), (7, "ÉTÉ"), (7, "été")]
    got = check(spark, docs, items)
    assert {r[0] for r in got} == {1, 5, None, 7}


def test_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(i, f"apple tree {i}") for i in range(5)], "doc_id long, text string")
    items = spark.createDataFrame([(0, "apple 3")], "item_id long, text string")
    clash = docs.selectExpr("*", "1 as n", "2 as q", "3 as score", "4 as rank", "5 as item_id", "6 as numbers")
    same = [sorted(op.search(d, items.selectExpr("*", "1 as doc_id")).collect()) for d in (docs, clash)]
    assert same[0] == same[1] and same[0][0].doc_id == 3
    assert op.search(docs.limit(0), items).collect() == [] and op.search(docs, items.limit(0)).collect() == []
