"""Exact dedup against brute force, with hashes that collide and blocks of a few bytes."""
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from eventide.llm import op7_exact_dedup as op7

SCHEMA = "doc_id long, text string, rid long, name string, level int, h string"

TEXTS = [
    (1, "a b c"), (2, "abc"), (3, " a\tb\nc \r\x0b\x0c"), (4, "abd"), (5, None), (6, ""), (7, " \n"), (8, "x" * 1000), (9, "x" * 999),
    (10, "x " * 1000), (11, "é" * 7), (12, "é é" + "é" * 5), (13, "abcabcabc"), (14, "abc abc abc"), (15, "abcabcab"),
    (16, "a b c"), (2, "abc"), (None, "abc"), (None, "zz"), (20, "z z"), (21, "x" * 1000 + " "),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 7, "n", 1, "h") for i, t in rows], SCHEMA)


def brute(rows):
    groups = {}
    for k, (i, t) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, k))
    out = []
    for text, members in groups.items():
        best = min(members)
        for m in members:
            i = rows[m[3]][0]
            out.append((i, rows[best[3]][0], len(members), m == best, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size,block_hash", [(4096, F.xxhash64), (4, F.xxhash64), (3, lambda c: F.pmod(F.xxhash64(c), F.lit(3)))])
def test_against_brute_force(spark, size, block_hash):
    got = op7.exact_duplicates(frame(spark, TEXTS).repartition(3), block_bytes=size, block_hash=block_hash).collect()
    want = brute(TEXTS)
    # of repeated rows of one id either may be the one that is kept
    strip = lambda rows: sorted(((r[0], r[1], r[2], r[4]) for r in rows), key=repr)
    assert strip(got) == strip(want)
    assert sorted((r[4] for r in got if r[3])) == sorted({r[4] for r in want})


def test_stage_keeps_one_row_of_a_group(spark):
    docs = frame(spark, TEXTS)
    kept = op7.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    norm = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in rows]
    assert len(norm) == len(set(norm)) == len({r[4] for r in brute(TEXTS)})
    want = {r[1] for r in brute(TEXTS)}
    assert {r.doc_id for r in rows} == want


def test_empty_table(spark):
    assert op7.exact_duplicates(frame(spark, [])).collect() == []
    assert op7.drop_exact_duplicates(frame(spark, [])).collect() == []


def test_no_python_in_the_plan(spark):
    plan = op7.exact_duplicates(frame(spark, TEXTS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
