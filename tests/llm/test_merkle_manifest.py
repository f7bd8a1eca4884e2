"""The Merkle manifest against a plain recursive build."""
import hashlib
import random
import zlib

import pytest

from eventide.llm import op11_merkle_manifest as op

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(doc_id, text, lang, source, n_chars):
    return H(*map(field, (doc_id, source, lang, n_chars, text)))


def up(hashes):
    """Root of a list, and of each member its siblings (left, right) level by level."""
    paths, at = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        for i, p in enumerate(at):
            run = hashes[p // 8 * 8:p // 8 * 8 + 8]
            paths[i].append(("".join(run[:p % 8]), "".join(run[p % 8 + 1:])))
        hashes = [H(*hashes[k:k + 8]) for k in range(0, len(hashes), 8)]
        at = [p // 8 for p in at]
    return hashes[0], paths


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for n in names:
        groups[n].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        built[n] = up([leaf(*r) for r in groups[n]])
    root, above = up([built[n][0] for n in names])
    out = []
    for n, top in zip(names, above):
        sub, paths = built[n]
        for r, own in zip(groups[n], paths):
            path = own + top
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None
            h = leaf(r[0], r[1].translate(LOWER) if bad else r[1], *r[2:])
            for left, right in path:
                h = H(left, h, right)
            out.append((r[0], leaf(*r), sub, root, H("".join(x + y for x, y in path)), h, h == root))
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in op.manifest(df).select(COLUMNS).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)
    return got


@pytest.mark.parametrize("n", [1, 8, 9, 513, 1100])
def test_sizes_of_a_tree(spark, n):
    """One group of one run, of more levels than a block has, and groups of one row beside it."""
    rng = random.Random(n)
    rows = [(i, f"Text {rng.random()}", "en", "s", i) for i in range(n)] + [(-1, "A", "de", None, 1), (-2, "b", None, "x", None)]
    got = check(spark, rows)
    assert not all(r[-1] for r in got) or n == 1


def test_many_groups(spark):
    """More groups than a block has: the tree over subroots has storeys of its own."""
    check(spark, [(i, "Ab é", f"l{i % 520}", None, 3) for i in range(1300)])


def test_edges(spark):
    """Nulls in every column, empty and very long texts, repeated ids and rows, and one lone row."""
    check(spark, [(3, "X", None, None, None)])
    rows = [(None, None, None, None, None), (None, "Q", "en", "s", 1), (4, "", "en", "", 0), (4, "", "en", "", 0),
            (4, "Z", "en", "s", 1), (5, "AÉ\n" * 300_000, "en", "s", 900_000), (6, None, "en", "s", 0), (7, "10:a", "", "s", 4)]
    got = check(spark, rows)
    assert {r[0]: r[-1] for r in got if r[0] == 6} == {6: True}


def test_columns_and_empty_table(spark):
    """Columns of clashing names are not read; an empty table has no rows."""
    rows = [(i, "T", "en", "s", 1) for i in range(20)]
    plain = spark.createDataFrame(rows, SCHEMA)
    clash = plain.selectExpr("*", "1 as tree", "2 as rank", "3 as n", "4 as h", "5 as rid", "6 as item", "7 as block", "8 as range")
    same = [sorted(op.manifest(d).select(COLUMNS).collect()) for d in (plain, clash)]
    assert same[0] == same[1]
    assert op.manifest(plain.limit(0)).collect() == []
