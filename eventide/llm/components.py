"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from eventide.llm.common import drop_staged, stage_table


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the smallest of the node and its neighbours."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.filter("v > u").join(least, "u")
            .select(F.col("v").alias("hi"), F.col("m").alias("lo")).filter("hi <> lo"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, comp) for every node of ``edges``; comp is the smallest node reachable.

    Null ends and loops are left out; repeated edges count once; no edges
    give no rows.  Each round is one written table of at most as many edges as
    before; only minima are gathered per node, so a hub's edges are combined on
    the mappers and its join can be split.  Rounds stop when a round changes
    nothing (about log of the longest path).
    """
    now, mark = _staged(edges.filter(f"{a} <> {b}").select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct())
    while True:
        new, before = _staged(_small_star(_large_star(now))), mark
        drop_staged(now)
        now, mark = new
        if mark == before:
            break
    roots = now.select(F.col("lo").alias("node")).distinct().withColumn("comp", F.col("node"))
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("comp")).unionByName(roots)


def _staged(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The written edges, and their count and order-free checksums: equal ones mean that a round changed nothing."""
    h, seen = F.xxhash64("hi", "lo"), Observation()
    table = stage_table(edges.observe(
        seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.shiftrightunsigned(h, 34)), F.lit(0)).alias("sum"),
        F.coalesce(F.bit_xor(h), F.lit(0)).alias("xor")), "edges")
    return table, (seen.get["n"], seen.get["sum"], seen.get["xor"])
