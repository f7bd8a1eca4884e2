"""A-6, R-6: mergeable summaries: latency quantiles over any time range, heavy keys of a log.

A sketch per hour is stored once and merged on read, so a range of any length
costs its hours, not its rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide import schemas as S

#: items of a quantile sketch: groups of no more values are held whole, beyond that ranks are off by about 2.3 / k
SKETCH_K = 4096


# A-6 ---------------------------------------------------------------------------------
def latency_sketches(df: DataFrame, ts: str, latency: str, by: list[str], k: int = SKETCH_K) -> DataFrame:
    """One KLL sketch per group and hour: by, hour, day, values, sketch (binary).  Values that are null count nowhere."""
    hour = F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz")
    rows = df.filter(F.col(latency).isNotNull()).withColumn("hour", hour)
    return rows.groupBy(*by, "hour").agg(
        F.count(F.lit(1)).alias("values"), F.kll_sketch_agg_double(F.col(latency).cast("double"), k).alias("sketch")).withColumn(
        "day", F.date_format("hour", "yyyy-MM-dd"))


def quantiles_of_range(sketches: DataFrame, since: str, until: str, by: list[str], quantiles: dict[str, float], k: int = SKETCH_K) -> DataFrame:
    """(by, values, one column per quantile) of the hours from ``since`` on and before ``until``, from their sketches alone.

    A quantile q is the smallest value with a share of at least q of the values
    at or under it: exact up to ``k`` values, with a rank error of about 2.3 / k
    beyond.  ``day`` prunes folders where the sketches are stored by day.
    """
    stamp = lambda s: F.lit(s).cast("timestamp_ntz")
    hours = sketches.filter((F.col("day") >= since[:10]) & (F.col("day") <= until[:10])
                            & (F.col("hour") >= stamp(since)) & (F.col("hour") < stamp(until)))
    merged = hours.groupBy(*by).agg(F.sum("values").alias("values"), F.kll_merge_agg_double("sketch", k).alias("sketch"))
    return merged.select(*by, "values", *[F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias(n) for n, q in quantiles.items()])


# R-6 ---------------------------------------------------------------------------------
def _summary(keys: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """At most ``k`` keys with their counts less the (k+1)-th largest, and what was taken off."""
    if len(keys) <= k:
        return keys, counts, 0
    off = int(np.partition(counts, len(counts) - k - 1)[len(counts) - k - 1])
    stay = counts > off
    return keys[stay], counts[stay] - off, off


def _misra_gries(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, error = np.zeros(0, object), np.zeros(0, np.int64), 0
        for batch in batches:
            pairs = batch.column("key").drop_null().value_counts()
            both = np.concatenate([keys, np.array(pairs.field("values").to_pylist(), object)])
            amounts = np.concatenate([counts, pairs.field("counts").to_numpy()])
            keys, at = np.unique(both.astype(str), return_inverse=True) if len(both) else (keys, np.zeros(0, np.int64))
            keys, counts, off = _summary(keys.astype(object), np.bincount(at, weights=amounts, minlength=len(keys)).astype(np.int64), k)
            error += off
        yield pa.RecordBatch.from_arrays([pa.array([*keys, None], pa.string()), pa.array([*counts, error], pa.int64())], names=["key", "count"])
    return run


def heavy_key_summary(log: DataFrame, key: str, k: int) -> DataFrame:
    """Misra-Gries summary (key, at_least, at_most) of a log: every key with more than rows / (k + 1) rows is in it.

    Tasks keep ``k`` counters each and say by how much a count may be short (the
    row of the null key); Spark adds the counters up.  Null keys are no keys.
    """
    parts = log.select(F.col(key).cast("string").alias("key")).mapInArrow(_misra_gries(k), "key string, count long")
    summed = parts.groupBy("key").agg(F.sum("count").alias("at_least"))
    error = summed.filter("key is null").select(F.col("at_least").alias("short"))  # one row
    return summed.filter("key is not null").join(F.broadcast(error)).select("key", "at_least", (F.col("at_least") + F.col("short")).alias("at_most"))


def heavy_keys(log: DataFrame, key: str, k: int) -> DataFrame:
    """(key, rows) of the keys with more than a (k + 1)-th of the rows that have a key, exactly.

    The summary names candidates; those that cannot reach the share are left
    out, which leaves at most ``2 k`` of them, and the others are counted.
    """
    rows = log.filter(F.col(key).isNotNull())
    total = rows.count()
    floor = total // (k + 1)
    candidates = heavy_key_summary(rows, key, k).filter(F.col("at_most") > floor).select("key")
    held = rows.select(F.col(key).cast("string").alias("key")).join(F.broadcast(candidates), "key")  # bounded by the summary
    return held.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > floor)


def balanced_assignment(heavy: list[tuple[str, int]], loads: list[int]) -> dict[str, int]:
    """Partition of each heavy key: heaviest first, each to the partition that is least loaded by then."""
    queue = [(load, p) for p, load in enumerate(loads)]
    heapq.heapify(queue)
    out = {}
    for key, rows in sorted(heavy, key=lambda h: (-h[1], h[0])):
        load, p = heapq.heappop(queue)
        out[key] = p
        heapq.heappush(queue, (load + rows, p))
    return out


def even_partitions(log: DataFrame, key: str, default, k: int, partitions: int = S.NUM_TOPIC_PARTITIONS) -> DataFrame:
    """``log`` with ``partition``: heavy keys by ``balanced_assignment``, all others by the column ``default``.

    Rows of a key stay together.  What the driver holds is bounded: at most ``k``
    heavy keys and a load per partition.
    """
    heavy = heavy_keys(log, key, k)
    told = [(r["key"], r["rows"]) for r in heavy.collect()]
    names = log.sparkSession.createDataFrame([(h,) for h, _ in told], "heavy_key string")
    rest = log.withColumn("__p", default).join(F.broadcast(names), F.col(key).cast("string") == F.col("heavy_key"), "left_anti")
    loads = {r["__p"]: r["n"] for r in rest.groupBy("__p").agg(F.count(F.lit(1)).alias("n")).collect()}
    placed = balanced_assignment(told, [loads.get(p, 0) for p in range(partitions)])
    table = log.sparkSession.createDataFrame([(h, p) for h, p in placed.items()], "heavy_key string, heavy_partition int")
    met = log.join(F.broadcast(table), F.col(key).cast("string") == F.col("heavy_key"), "left")
    return met.withColumn("partition", F.coalesce("heavy_partition", default)).drop("heavy_key", "heavy_partition")
