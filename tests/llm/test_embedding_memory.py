"""Memory of embedding near-dedup: shards bounded in bytes, graphs that travel as rows, links of dense clusters as bits."""
import numpy as np
from pyspark.sql import functions as F
from test_embedding_dedup import brute, clustered, frame

from eventide.llm import op4_embedding_dedup as op4
from eventide.llm.hnsw import Hnsw, unit


def test_a_shard_is_bounded_in_bytes_and_its_graph_travels_as_rows(spark, monkeypatch):
    rows, seen, stage = list(enumerate(clustered(5, 400, 16))), [], op4.stage_table

    def staged(df, name):
        table = stage(df, name)
        if name == "index":
            large = F.greatest(F.lit(0), *[F.length(c) for c, kind in table.dtypes if kind == "binary"])
            seen.append(table.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.max(large).alias("bytes")).collect())
        return table
    monkeypatch.setattr(op4, "stage_table", staged)
    monkeypatch.setattr(op4, "SHARD_BYTES", 50 * 16 * 8, raising=False)
    monkeypatch.setattr(op4, "LANE_ROWS", 150, raising=False)
    got = op4.near_vectors(frame(spark, rows), shards=2).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
    assert len(seen[0]) == 8 and sum(r["n"] for r in seen[0]) == 400
    assert max(r["bytes"] for r in seen[0]) < 1000


def test_a_graph_is_the_same_from_its_ties():
    x = unit(np.random.default_rng(0).normal(size=(700, 8))).astype(np.float32)
    graph = Hnsw.build(x)
    again = Hnsw.tied(x, graph.ties())
    assert len(graph.links) > 1 and len(graph.levels) == len(again.levels)
    assert all((a == b).all() for a, b in zip(graph.levels + graph.links, again.levels + again.links))


def test_links_of_a_dense_cluster_take_a_bit_each():
    rng = np.random.default_rng(3)
    x = unit(rng.normal(size=(1, 8)) + rng.normal(size=(2000, 8)) * 0.02).astype(np.float32)
    found = Hnsw(x, [np.arange(2000)], [np.full((2000, 24), -1, np.int32)]).within(x, 0.9, 1, 0)
    assert all(len(f) == 2000 for f in found)
    held = getattr(found, "rows", found)
    assert sum(f.nbytes for f in held) <= 2000 * 2000 // 8
