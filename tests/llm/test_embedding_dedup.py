"""Embedding near-dedup against brute force over all pairs."""
import numpy as np

from eventide.llm import op4_embedding_dedup as op4
from eventide.llm.hnsw import Hnsw, unit

SCHEMA = "vec_id long, embedding array<float>, label int, cid long, vec string, shard long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "v", 2) for i, v in rows], SCHEMA)


def brute(rows):
    good = [i is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for i, v in rows]
    vec = [unit(np.array([np.float32(x) for x in v], float)[None])[0] if g else None for g, (_, v) in zip(good, rows)]
    near = [[b for b in range(len(rows)) if b != a and good[a] and good[b] and len(vec[a]) == len(vec[b]) and vec[a] @ vec[b] >= 0.9]
            for a in range(len(rows))]
    comp = [i for i, _ in rows]
    while True:
        new = [min([c] + [comp[b] for b in near[a]]) if near[a] else c for a, c in enumerate(comp)]
        if new == comp:
            return sorted(((i, len(near[k]), comp[k], i is None or comp[k] == i) for k, (i, _) in enumerate(rows)), key=repr)
        comp = new


def clustered(seed, n, dim):
    rng = np.random.default_rng(seed)
    out = []
    while len(out) < n:
        centre = rng.normal(size=dim)
        for _ in range(int(rng.choice([1, 1, 2, 5, 40]))):
            out.append((centre + rng.normal(size=dim) * rng.choice([0.05, 0.25, 0.45])).astype(np.float32).tolist())
    return out[:n]


def test_against_brute_force(spark):
    rows = [(1000 - k, v) for k, v in enumerate(clustered(3, 300, 16))]
    one = rows[0][1]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] + [1.0] * 15), (2004, [None] + [1.0] * 15), (2005, [float("inf")] * 16),
             (2006, one), (2007, [2 * x for x in one]), (2008, [-x for x in one]), (2008, one), (2009, one[:8]), (2010, one[:8]), (None, one), (None, None),
             (2011, [1e30 * x for x in one])]
    got = op4.near_vectors(frame(spark, rows).repartition(3), shards=3).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_one_vector_and_empty_table(spark):
    assert [tuple(r) for r in op4.near_vectors(frame(spark, [(7, [1.0, 2.0])])).collect()] == [(7, 0, 7, True)]
    assert op4.near_vectors(frame(spark, [])).collect() == []


def test_graph_finds_large_groups():
    x = unit(np.array(clustered(8, 2500, 32), float))
    centre = x[:1]
    x = np.vstack([x, unit(centre + np.random.default_rng(1).normal(size=(400, 32)) * 0.02)])
    graph = Hnsw.build(x.astype(np.float32))
    found = op4.audited_links(graph, x, 0.9)
    truth = x @ x.T >= 0.9
    hit = sum(truth[i, f].sum() for i, f in enumerate(found))
    assert hit >= 0.999 * truth.sum()
    assert all((graph.links[0][v] != v).all() for v in range(len(x)))


def test_a_dense_cluster_takes_no_beams_of_its_size():
    """3,000 different near vectors among 6,000 loose ones: every link is found, in time that the links allow."""
    import time
    rng = np.random.default_rng(2)
    near = rng.normal(size=(1, 64)) + rng.normal(size=(3000, 64)) * 0.05
    x = unit(np.vstack([near, rng.normal(size=(6000, 64))]))
    graph = Hnsw.build(x.astype(np.float32))
    start = time.time()
    found = op4.audited_links(graph, x, 0.9)
    took = time.time() - start
    truth = x @ x.T >= 0.9
    np.fill_diagonal(truth, False)
    assert truth.sum() >= 3000 * 2999
    assert sum(truth[i, f].sum() for i, f in enumerate(found)) == truth.sum() and took < 120


def test_the_audit_counts_each_query_alike():
    """One cluster holds nearly all links; isolated pairs that the first beams miss still widen them."""
    rng = np.random.default_rng(4)
    hub = rng.normal(size=(1, 16)) + rng.normal(size=(400, 16)) * 0.01
    pairs = rng.normal(size=(100, 16))
    x = unit(np.vstack([hub, pairs, pairs + rng.normal(size=(100, 16)) * 0.01]))
    graph, widths = Hnsw.build(x.astype(np.float32)), []
    within = graph.within

    def blind(q, least, width, widest):
        widths.append(width)
        found = within(q, least, width, widest)
        return found if width > op4.BEAM else [f if i < 400 else np.array([i]) for i, f in enumerate(found)]
    graph.within = blind
    found = op4.audited_links(graph, x, 0.9)
    assert widths == [op4.BEAM, 2 * op4.BEAM] and len(found[450]) == 2
