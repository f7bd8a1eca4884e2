"""MinHash near-dedup against brute force over all pairs."""
import random

import numpy as np
import pytest

from eventide.llm import op8_minhash_dedup as op8
from eventide.llm.words import shingle_set

SCHEMA = "doc_id long, text string, vid long, key string, comp string, digest string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "k", "c", "d") for i, t in rows], SCHEMA)


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))}


def brute(rows, width):
    sets = [shingles(t, width) for _, t in rows]
    up = list(range(len(rows)))

    def root(v):
        while up[v] != v:
            v = up[v]
        return v
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if rows[a][0] is not None and rows[b][0] is not None and sets[a] and sets[b] and \
                    100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                up[root(a)] = root(b)
    least = {}
    for v, (i, _) in enumerate(rows):
        if i is not None:
            least[root(v)] = min(least.get(root(v), i), i)
    return sorted(((i, len(sets[v]), least.get(root(v)), i is None or least[root(v)] == i) for v, (i, _) in enumerate(rows)), key=repr)


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 5)))
    passage = " ".join(word() for _ in range(40))
    rows = []
    for g in range(12):
        base = [word() for _ in range(r.choice([3, 4, 5, 30, 80, 150]))]
        for _ in range(r.randint(1, 9)):
            own = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4, 8])):
                own[r.randrange(len(own))] = word()
            rows.append(" ".join(own) + (" " + passage if g % 3 == 0 else ""))
    r.shuffle(rows)
    return [(3 * k + 1, t) for k, t in enumerate(rows)]


@pytest.mark.parametrize("seed,width", [(1, 4), (2, 5)])
def test_against_brute_force(spark, seed, width):
    rows = corpus(seed) + [(900, None), (901, ""), (902, " \n\t"), (903, "One two"), (904, "one  TWO"), (905, "one two three"),
                           (906, "ÉA b c d e f g"), (907, "éa b c d e f g"), (None, "one two"), (None, None),
                           (950, "q r s t u v w"), (950, "q r s t u v w"), (951, "q r s t u v w"), (951, "other words than those there")]
    got = op8.near_duplicates(frame(spark, rows).repartition(3), width=width).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, width)


def test_a_large_group_is_one_component(spark):
    """Copies around one base: most pairs of them are no links, all are reached through the base."""
    r = random.Random(5)
    base = [f"w{k}" for k in range(200)]
    rows = [(0, " ".join(base))]
    for k in range(1, 60):
        own = list(base)
        for j in r.sample(range(200), 4):
            own[j] = f"x{k}.{j}"
        rows.append((k, " ".join(own)))
    r.shuffle(rows)
    got = op8.near_duplicates(frame(spark, rows), width=4).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, 4)


def test_minima_are_exact_over_chunks(monkeypatch):
    monkeypatch.setattr(op8, "_CHUNK", 7)
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in (1, 20, 3, 7, 14, 1)]
    a, b = op8.hash_family(6)
    want = np.array([[int((s * a[k] + b[k]).min() >> np.uint64(32)) for k in range(6)] for s in sets])
    assert (op8.minima(sets, a, b) == want).all()
    assert op8.minima([], a, b).shape == (0, 6)


def test_shingles_are_distinct_by_place_and_number_of_words():
    assert len(shingle_set("a b c", 4)) == 1
    assert shingle_set("a b c", 4)[0] != shingle_set("c b a", 4)[0]
    assert shingle_set("a b", 4)[0] != shingle_set("a b c", 4)[0]
    assert (shingle_set("A b C d e", 4) == shingle_set("a B c D E", 4)).all()


def test_stage_and_empty_table(spark):
    rows = corpus(3)
    docs = frame(spark, rows)
    kept = op8.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(x[0] for x in brute(rows, 5) if x[3])
    assert op8.near_duplicates(frame(spark, [])).collect() == []
