"""Exact dedup by deterministic block naming (DataFrame functions only).

The normalised text of a document is cut into blocks of fixed size.  The
distinct blocks are sorted and numbered; then adjacent names are paired, the
distinct pairs sorted and numbered again, until a document has one name.  Two
documents have the same (level, name) if and only if their texts are equal:
names stand for blocks and pairs themselves, hashes only route rows to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from eventide.llm.common import WHITE, bind, drop_staged, spare_name, stage_table

BLOCK_BYTES = 4096


def normalised(text):
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{WHITE}+", "")


def _blocks(binary, size: int):
    """Array of the fixed-size blocks of a binary column; empty text is one empty block."""
    n = lambda b: F.greatest(F.ceil(F.length(b) / F.lit(size)).cast("int"), F.lit(1))
    return bind(binary, lambda b: F.transform(
        F.sequence(F.lit(0), n(b) - 1), lambda i: F.substring(b, i * size + 1, F.lit(size))))


def _numbered(distinct_rows: DataFrame, keys: list[str]) -> DataFrame:
    """Integer names of sorted distinct rows: sorted in each hash partition, numbered in that order."""
    return distinct_rows.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def _block_names(blocks: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Names of the distinct blocks as (h, name), and (h, block, name) of blocks whose hash is shared.

    The text is shuffled once, combined on the mappers.  Rows find their name
    by the 8-byte hash; where two different blocks share one, by the block.
    """
    names = stage_table(_numbered(blocks.distinct(), ["h", "block"]).select("h", "name"), "block-names")
    shared = names.groupBy("h").agg(F.sort_array(F.collect_set("name")).alias("names")).filter("size(names) > 1")
    if shared.isEmpty():
        return names, None
    told = (blocks.join(shared.select("h"), "h", "left_semi").distinct()
            .withColumn("k", F.row_number().over(W.partitionBy("h").orderBy("block"))))
    told = told.join(shared, "h").select("h", "block", F.expr("names[k - 1]").alias("name"))
    return names.join(shared, "h", "left_anti"), stage_table(told, "shared-hash-names")


def text_identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    block_bytes: int = BLOCK_BYTES, block_hash=F.xxhash64) -> DataFrame:
    """One row per input row: (rid, doc_id, n_cp, text_sha256, level, name); equal texts share (level, name)."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    cut = src.select("doc_id", F.char_length(F.coalesce("text", F.lit(""))).alias("n_cp"),
                     normalised(F.col("text")).cast("binary").alias("bin"))
    blocks = (cut.select(F.explode(_blocks(F.col("bin"), block_bytes)).alias("block"))
              .select(block_hash("block").cast("long").alias("h"), "block"))
    names, told = _block_names(blocks)

    keep_blocks = [] if told is None else [_blocks(F.col("bin"), block_bytes).alias("bs")]
    rows = stage_table(cut.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", "n_cp", F.sha2("bin", 256).alias("text_sha256"),
        F.transform(_blocks(F.col("bin"), block_bytes), lambda b: block_hash(b).cast("long")).alias("hs"),
        *keep_blocks), "rows")
    level = rows.select("rid", F.size("hs").alias("left"), F.posexplode("hs").alias("pos", "h"))
    if told is None:
        level = level.join(names, "h")
    else:
        exact = (rows.select("rid", F.posexplode("bs").alias("pos", "block"))
                 .select("rid", "pos", block_hash("block").cast("long").alias("h"), "block").join(told, ["h", "block"]))
        level = (level.join(names, "h").select("rid", "left", "pos", "name")
                 .unionByName(level.join(exact.select("rid", "pos", "name"), ["rid", "pos"])
                              .select("rid", "left", "pos", "name")))
    level = stage_table(level.select("rid", "left", "pos", "name"), "level")

    done, depth = [], 0
    while True:
        done.append(level.filter("left = 1").select("rid", F.lit(depth).alias("level"), "name"))
        if level.filter("left > 1").isEmpty():
            break
        pairs = (level.filter("left > 1")
                 .groupBy("rid", F.expr("pos div 2").cast("int").alias("pos"))
                 .agg(F.max("left").alias("left"), F.max(F.expr("if(pos % 2 = 0, name, null)")).alias("a"),
                      F.coalesce(F.max(F.expr("if(pos % 2 = 1, name, null)")), F.lit(-1)).alias("b")))
        pairs = stage_table(pairs, "pairs")
        named = stage_table(_numbered(pairs.select("a", "b").distinct(), ["a", "b"]), "pair-names")
        level = stage_table(pairs.join(named, ["a", "b"]).select(
            "rid", F.expr("cast((left + 1) div 2 as int)").alias("left"), "pos", "name"), "level")
        drop_staged(pairs)
        depth += 1
    identity = done[0]
    for more in done[1:]:
        identity = identity.unionByName(more)
    return rows.drop("hs", "bs").join(identity, "rid")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     block_bytes: int = BLOCK_BYTES, block_hash=F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without white space.  Of equal texts the row
    with the most code points in the original stays, then the smallest doc_id (a
    null id after all others), then the first of repeated rows, so that exactly
    one row of a group is kept.  Null text counts as empty; texts may be of any
    length; an empty table gives no rows; extra columns are not read.
    """
    rows = text_identities(docs, id_col, text_col, block_bytes, block_hash)
    rows = stage_table(rows, "identities")
    rank = F.struct((-F.col("n_cp")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")
    groups = rows.groupBy("level", "name").agg(
        F.count(F.lit(1)).alias("group_size"), F.min(rank).alias("best")).select(
        "level", "name", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.rid").alias("keep_rid"))
    groups = stage_table(groups, "groups")  # a table on either side, so that the join can split a large group
    return rows.join(groups, ["level", "name"]).select(
        "doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they came (the row named by ``keep_id``).

    Of rows that share the id and the text that stays, the first by text and
    then by all columns as JSON: whichever of equal rows is the same row.
    """
    named, place = spare_name(docs, "op7_key"), spare_name(docs, "op7_place")
    key = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.sha2(normalised(F.col(text_col)), 256))
    kept = exact_duplicates(docs, id_col, text_col).filter("kept").select(
        F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "text_sha256").alias(named))
    order = [F.char_length(F.coalesce(F.col(text_col), F.lit(""))).desc(), F.col(text_col),
             F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns]))]
    return (docs.withColumn(named, key).join(kept, named, "left_semi")
            .withColumn(place, F.row_number().over(W.partitionBy(named).orderBy(*order))).filter(F.col(place) == 1)
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
