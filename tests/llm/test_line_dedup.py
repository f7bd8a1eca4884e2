"""Line dedup against brute force; the perfect hash against its definition."""
import random

import numpy as np
import pytest

from eventide.llm import op12_line_dedup as op
from eventide.llm.common import stage_table
from eventide.llm.perfect_hash import MinimalPerfectHash

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string"


def key(line):
    return line.strip(WHITE).translate(LOWER)


def brute(rows, min_docs=3):
    held = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            held.setdefault(key(line), set()).add(-1 if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 20 and len(held[key(x)]) >= min_docs and max(held[key(x)]) != i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def check(spark, rows, **sizes):
    got = op.dedup_lines(spark.createDataFrame(rows, SCHEMA).repartition(3), **sizes)
    got = sorted((tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", "text").collect()), key=repr)
    assert got == brute(rows, sizes.get("min_docs", 3))
    return got


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash(n):
    """Every key has a number of its own under n; halves may repeat; a dumped hash gives the same numbers."""
    rng = np.random.default_rng(n)
    a = rng.integers(0, 2**63, n).astype(np.uint64)
    b = rng.integers(0, max(1, n // 8), n).astype(np.uint64)  # most of them repeat
    table = MinimalPerfectHash.build(a, b)
    assert sorted(table.numbers(a, b)) == list(range(n)) and table.size == n
    again = MinimalPerfectHash.load(*table.dump())
    assert (again.numbers(a, b) == table.numbers(a, b)).all()
    other = rng.integers(0, 2**63, 1000).astype(np.uint64)
    assert set(table.numbers(other, other)) <= set(range(-1, n))
    if n:
        assert sum(table.dump()[0]) < 6 * n + 64 * 64


@pytest.mark.parametrize("sizes", [{}, {"shard_lines": 3, "batch_bytes": 200, "probe_bytes": 64}, {"min_docs": 2}])
def test_brute_force(spark, sizes):
    """Shared lines in many documents, one line in all of them; many shards, slices and batches give the same rows."""
    rng = random.Random(5)
    pool = [f"A shared Line with number {i} in it" for i in range(40)]
    rows = []
    for i in range(150):
        lines = [rng.choice(pool) for _ in range(rng.randint(0, 4))] + ["the line that ALL documents hold "[:34].strip()]
        lines += [f"a line of document {i} alone {rng.random()}", "short", "  " + pool[i % 7].upper() + "\t"]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    assert sum(r[2] for r in check(spark, rows, **sizes)) > 200


def test_edges(spark):
    """Nulls, empty texts, blank lines, limits in code points, repeated ids and rows, long texts."""
    nineteen, twenty, wide = "x" * 19, "x" * 20, "é" * 20
    rows = [(None, twenty), (None, twenty), (1, None), (2, ""), (3, f"{nineteen}\n{twenty}\r\n\n{wide}"), (4, f" {twenty} \n{wide}"),
            (5, f"{'X' * 20}\n{twenty}\n{wide}"), (5, f"{'X' * 20}\n{twenty}\n{wide}"), (6, f"{nineteen}\n{'É' * 20}\n {twenty}"),
            (7, "\n" * 10), (8, nineteen), (9, nineteen), (10, "lone " * 200_000 + "\n" + twenty)]
    got = check(spark, rows)
    assert [r for r in got if r[0] is None] == [(None, 1, 1, "")] * 2
    assert check(spark, [(1, twenty), (2, twenty)])[0][2] == 0


def test_columns_and_empty_table(spark):
    rows = [(i, f"a line that five documents hold\n{i}") for i in range(5)]
    plain = spark.createDataFrame(rows, SCHEMA)
    clash = plain.selectExpr("*", "1 as batch", "2 as n_lines", "3 as hashes", "4 as shard", "5 as hits")
    same = [sorted(op.dedup_lines(d).collect()) for d in (plain, clash)]
    assert same[0] == same[1] and [r.n_dropped for r in same[0]] == [1, 1, 1, 1, 0]
    assert op.dedup_lines(plain.limit(0)).collect() == []


def test_index(spark):
    """The arrays of a shard stand in the order of its hash: each line finds its documents and its largest one."""
    rows = [(i, f"{'a line of many documents'}\n{'a line of one pair ' + str(i // 2)}") for i in range(60)]
    split = stage_table(spark.createDataFrame(rows, SCHEMA).mapInArrow(op._split(500), op._SPLIT), "split")
    index, shards = op.build_index(split, shard_lines=8)
    assert shards == 4
    found = {}
    for r in index.collect():
        table = MinimalPerfectHash.load(r.level_bits, bytes(r.levels))
        assert table.size == r.n
        for text in {t for _, t in rows}:
            for line in text.split("\n"):
                a, b = np.frombuffer(op.line_hash(line.encode()), "<u8")
                at = table.numbers(np.array([a]), np.array([b]))[0]
                if at >= 0 and np.frombuffer(r.prints, "<u8")[at] == b:
                    found[line] = (r.docs[at], int(np.frombuffer(r.last, "<i8")[at]))
    assert found["a line of many documents"] == (60, 59)
    assert found["a line of one pair 7"] == (2, 15) and len(found) == 31
