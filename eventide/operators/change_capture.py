"""S-8: a table's initial snapshot joined with its running change log.

The table is read in chunks of its key range while changes go on.  Marks in the
log bracket each read: a row of a chunk is as old as the chunk's low mark at
least, and no newer than its high mark.  Changes after the low mark win over the
snapshot's row, whether or not the read already saw them; changes up to it are
in the snapshot.  So chunks can be read at any time and in any order,
without stopping the log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.operators.tables import compact_latest

#: a change as the log carries it: the row before and after as JSON objects
ENVELOPE = "op string, before string, after string, ts_ms long, lsn long"


def envelope(op: Column, before: Column, after: Column, ts_ms: Column, lsn: Column) -> Column:
    """A change row's value as JSON text; absent images are left out."""
    return F.to_json(F.struct(op.alias("op"), before.alias("before"), after.alias("after"), ts_ms.alias("ts_ms"), lsn.alias("lsn")))


def parse_envelope(log: DataFrame, row_schema: str, value: str = "value") -> DataFrame:
    """``log`` (key, value) as key, op, lsn, ts_ms, before, row; a value that is no change has op null.

    A null value is the tombstone that follows a delete in a compacted topic; it
    says nothing that the delete has not.
    """
    got = log.select("key", F.from_json(value, ENVELOPE).alias("e"))
    return got.select("key", "e.op", "e.lsn", "e.ts_ms", F.from_json("e.before", row_schema).alias("before"),
                      F.from_json("e.after", row_schema).alias("row"))


def chunk_of(key_number: Column, bounds: list[int]) -> Column:
    """Number of the key-range chunk: keys under the first bound are chunk 0, and so on."""
    return F.lit(0) + sum((F.when(key_number >= b, 1).otherwise(0) for b in bounds), F.lit(0))


def snapshot_and_changes(snapshot: DataFrame, changes: DataFrame, marks: DataFrame, chunk: Column, with_tombstones: bool = False) -> DataFrame:
    """Current rows (key, lsn, row, deleted) of a table by its chunked snapshot and its change log.

    ``snapshot`` has key and row, ``changes`` key, op, lsn and row, ``marks`` one
    row per chunk that was read (chunk, low, high); ``chunk`` is computed from key
    on both sides.  Changes of a chunk that was not read yet count from the first.
    Deleted keys are left out, or kept as tombstones.
    """
    m = marks.select(F.col("chunk").alias("__chunk"), "low")
    kind = dict(changes.dtypes)["row"]
    held = snapshot.select("key", F.col("row").cast(kind).alias("row"), chunk.alias("__chunk")).join(m, "__chunk").select(
        "key", F.col("low").alias("lsn"), F.lit(False).alias("deleted"), "row", F.lit(0).alias("__kind"))
    # a chunk that nobody has read yet has no mark: all its changes count
    since = changes.withColumn("__chunk", chunk).join(m, "__chunk", "left").filter(F.col("low").isNull() | (F.col("lsn") > F.col("low")))
    told = since.filter(F.col("op").isNotNull()).select("key", "lsn", (F.col("op") == "d").alias("deleted"), "row", F.lit(1).alias("__kind"))
    now = compact_latest(held.unionByName(told), ["key"], ["lsn", "__kind"]).drop("__kind")
    return now if with_tombstones else now.filter(~F.col("deleted"))
