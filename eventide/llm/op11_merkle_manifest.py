"""Merkle manifest of a dataset, by rolling rank digits up into nested structs.

Leaves get their rank in their group; the octal digits of a rank are the path
from the root.  Within blocks of 512 ranks the last digit is grouped away, then
the next, each grouping nesting the structs of the one before under their
parent's digest.  Block digests are the nodes of the next storey, until a group
is one node.  Back down, each block meets the proof of its own digest, and the
nested structs are transformed and exploded into one proof per node.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventide.llm.common import ascii_lower, stage_table

#: nodes of a run
FAN = 8
#: digits rolled up within a block: 512 ranks
DIGITS = 3
BLOCK = FAN ** DIGITS


def hashed(*parts: Column) -> Column:
    """Lowercase hex sha256 of the concatenated parts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def tampered(doc_id: Column) -> Column:
    """Whether the audit tampers with a row: 3 divides crc32 of its decimal id; a null id is left alone."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0, nulls first) within their ``tree`` and the tree's size ``n``.

    Rows are range-partitioned on (tree, order), so that a tree of any size is
    spread over tasks; ranks continue from a table of one row per range and tree.
    """
    laid = stage_table(rows.repartitionByRange("tree", *order).withColumn("range", F.spark_partition_id()), "merkle-ranges")
    sizes = laid.groupBy("tree", "range").agg(F.count(F.lit(1)).alias("own"))
    tree = W.partitionBy("tree")
    upto = tree.orderBy("range").rowsBetween(W.unboundedPreceding, W.currentRow)
    carry = sizes.select(F.col("tree").alias("c_tree"), F.col("range").alias("c_range"),
                         (F.sum("own").over(upto) - F.col("own")).alias("before"), F.sum("own").over(tree).alias("n"))
    place = F.row_number().over(W.partitionBy("tree", "range").orderBy(*order)) - 1
    here = laid.withColumn("place", place)
    met = here.join(carry, here["tree"].eqNullSafe(carry["c_tree"]) & (here["range"] == carry["c_range"]))
    return met.withColumn("rank", F.col("before") + F.col("place")).drop("range", "place", "before", "c_tree", "c_range")


def _digit(k: int) -> Column:
    return F.pmod(F.floor(F.col("rank") / F.lit(FAN ** k)), F.lit(FAN)).cast("int")


def _joined(kids: Column) -> Column:
    return F.array_join(F.transform(kids, lambda x: x["h"]), "")


def rolled(nodes: DataFrame) -> DataFrame:
    """Blocks (tree, n, block, h, kids) of nodes (tree, n, rank, h, item).

    Each grouping takes one rank digit away.  ``h`` of a run is the digest of its
    nodes, as long as the level has more than one node; ``kids`` nests them.
    """
    rows = nodes.select("tree", "n", F.floor(F.col("rank") / BLOCK).alias("block"),
                        *[_digit(k).alias(f"d{k}") for k in range(1, DIGITS)],
                        F.struct(_digit(0).alias("d"), "h", "item").alias("kid"))
    rows = rows.repartition("tree", "block")  # every grouping below keeps to it
    for k in range(DIGITS):
        digits = [f"d{j}" for j in range(DIGITS - 1, k, -1)]
        rows = rows.groupBy("tree", "n", "block", *digits).agg(F.sort_array(F.collect_list("kid")).alias("kids"))
        more = F.col("n") > FAN ** k  # nodes of this level are more than one
        h = F.when(more, F.sha2(_joined(F.col("kids")).cast("binary"), 256)).otherwise(F.col("kids")[0]["h"])
        if k < DIGITS - 1:
            rows = rows.select("tree", "n", "block", *digits[:-1],
                               F.struct(F.col(digits[-1]).alias("d"), h.alias("h"), "kids").alias("kid"))
        else:
            rows = rows.select("tree", "n", "block", h.alias("h"), "kids")
    return rows


def climb(nodes: DataFrame) -> list[DataFrame]:
    """The storeys of blocks above nodes (tree, n, rank, h, item); in the last each tree is one block and its ``h`` the root."""
    storeys = []
    while True:
        blocks = stage_table(rolled(nodes), "merkle-blocks")
        storeys.append(blocks)
        if not blocks.agg(F.max("block")).first()[0]:
            return storeys
        nodes = blocks.select("tree", F.ceil(F.col("n") / BLOCK).alias("n"), F.col("block").alias("rank"), "h",
                              F.lit(0).alias("item"))


def descend(storeys: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Nodes (tree, h, item, path, told) of the lowest storey; ``tops`` (tree, path, told) says what is above each root.

    ``path`` has per level, bottom first, the digests left (l) and right (r) of
    the node in its run.  Blocks and the paths above them meet by grouping.
    """
    above = tops.select("tree", F.lit(0).cast("long").alias("block"), "path", "told")
    for blocks in reversed(storeys):
        # the halves of a block: nested kids from below, path from above
        met = (blocks.select("tree", "block", "n", "kids").unionByName(above, allowMissingColumns=True)
               .groupBy("tree", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("n", "kids", "path", "told")])
               .withColumn("rank", F.col("block")))
        for k in reversed(range(DIGITS)):
            kids = F.col("kids")
            each = F.transform(kids, lambda x, i: F.struct(
                x.alias("kid"), _joined(F.slice(kids, F.lit(1), i)).alias("l"), _joined(F.slice(kids, i + 2, F.lit(FAN))).alias("r")))
            own = F.struct(F.col("e.l").alias("l"), F.col("e.r").alias("r"))
            met = met.select("tree", "block", "n", "path", "told", "rank", F.explode(each).alias("e")).select(
                "tree", "block", "n", "told", (F.col("rank") * FAN + F.col("e.kid.d")).alias("rank"), F.col("e.kid.h").alias("h"),
                F.when(F.col("n") > FAN ** k, F.concat(F.array(own), F.col("path"))).otherwise(F.col("path")).alias("path"),
                F.col("e.kid.kids" if k else "e.kid.item").alias("kids" if k else "item"))
        above = met.select("tree", F.col("rank").alias("block"), "path", "told")
    return met.select("tree", "h", "item", "path", "told")


def leaves(docs: DataFrame, fields: list[str], id_col: str, group_col: str, text_col: str) -> DataFrame:
    """Written rows (tree, doc_id, rid, h, bad): the digest of every row, and of its tampered form where it is tampered."""
    own = {c: F.col(c) for c in fields}
    bad = {**own, text_col: ascii_lower(F.col(text_col))}
    id_ = F.col(id_col)
    return stage_table(docs.select(
        F.col(group_col).alias("tree"), id_.cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("rid"),
        hashed(*[field(c) for c in own.values()]).alias("h"),
        F.when(tampered(id_), hashed(*[field(c) for c in bad.values()])).alias("bad")), "merkle-leaves")


def manifest(docs: DataFrame, fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
             id_col: str = "doc_id", group_col: str = "lang", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, proof.

    A leaf hashes ``fields``, null ones as ``-``; leaves of a group ascend by id
    (null ids first, repeated ids by their leaf, equal rows in any order, which
    changes no digest); groups ascend by name, null first.  Empty texts have a
    length of 0; texts count whole; an empty table gives no rows; other columns
    are not read.  ``proof`` lists the siblings level by level, left and right
    ones apart; ``folded_root`` folds them from the leaf, which is recomputed
    after lower-casing A-Z where ``tampered`` says so.
    """
    rows = ranked(leaves(docs, list(fields), id_col, group_col, text_col), ["doc_id", "h", "rid"])
    below = climb(rows.select("tree", "n", "rank", "h", F.struct("doc_id", "bad").alias("item")))
    subroots = below[-1].select(F.lit(0).alias("tree"), F.struct(F.col("tree").alias("name")).alias("item"), "h")
    top = climb(ranked(subroots, ["item"]))
    kind = "array<struct<l:string,r:string>>"
    roots = descend(top, top[-1].select("tree", F.array().cast(kind).alias("path"), F.col("h").alias("told")))
    nodes = descend(below, roots.select(F.col("item.name").alias("tree"), "path",
                                        F.struct(F.col("h").alias("subroot"), F.col("told").alias("root")).alias("told")))
    start = F.coalesce("item.bad", "h")
    folded = F.aggregate("path", start, lambda h, s: hashed(s["l"], h, s["r"]))
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["l"], s["r"])), "")
    return nodes.select(
        F.col("item.doc_id").alias("doc_id"), F.col("h").alias("leaf"), F.col("told.subroot").alias("subroot"),
        F.col("told.root").alias("root"), F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"),
        folded.alias("folded_root"), F.col("path").alias("proof")).withColumn("verified", F.col("folded_root") == F.col("root"))
