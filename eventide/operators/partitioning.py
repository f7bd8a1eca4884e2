"""R-1 .. R-7: partition routing as Column expressions.

Each partitioner returns an integer partition Column, so it composes with
``repartitionById`` (explicit layout), a Kafka sink's ``partition`` column,
or ``partitionBy`` on a file sink.  All of it is per-row JVM expression
work: no shuffle, no UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide import schemas as S
from eventide.functions.hashing import md5_mod, murmur2


def _range_lookup(region: Column) -> tuple[Column, Column]:
    starts, sizes = [], []
    for r, (lo, hi) in S.REGION_PARTITION_RANGES.items():
        starts += [F.lit(r), F.lit(lo)]
        sizes += [F.lit(r), F.lit(hi - lo + 1)]
    return (F.try_element_at(F.create_map(*starts), region),
            F.try_element_at(F.create_map(*sizes), region))


def _bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _null_key_slot(available: list[int], seed: int) -> Column:
    avail = F.array(*[F.lit(p) for p in available])
    return F.element_at(avail, (F.floor(F.rand(seed) * len(available)) + 1).cast("int"))


def _hash_slot(h: Column, available: list[int]) -> Column:
    avail = F.array(*[F.lit(p) for p in available])
    return F.element_at(avail, (F.pmod(h, F.lit(len(available))) + 1).cast("int"))


def default_partition(key: str, available: list[int], null_key_seed: int = 0) -> Column:
    """R-3: ``available[murmur2(key) % n]``, hashed once a row; a null key gets a random available slot."""
    slot = _bind(murmur2(key), lambda h: _hash_slot(h, available))
    return F.when(F.col(key).isNull(), _null_key_slot(available, null_key_seed)).otherwise(slot)


def region_partition(key: str, region: str, available: list[int] | None = None,
                     null_key_seed: int = 0) -> Column:
    """R-1 + R-2: start of the region's range + murmur2(key) % range size;
    when that slot is unavailable the next slots of the range are probed in
    order, then the default partitioner over the available ones is used.
    Unknown region -> default partitioner; null key -> random available."""
    available = list(range(S.NUM_TOPIC_PARTITIONS)) if available is None else available
    start, size = _range_lookup(F.col(region))
    all_up = set(available) >= set(range(S.NUM_TOPIC_PARTITIONS))
    avail = F.array(*[F.lit(p) for p in available])

    def route(h: Column) -> Column:
        default = _hash_slot(h, available)
        if all_up:
            ranged = start + F.pmod(h, size).cast("int")
        else:
            probes = F.transform(F.sequence(F.lit(0), size - 1),
                                 lambda o: start + F.pmod(h + o, size).cast("int"))
            up = F.filter(probes, lambda p: F.array_contains(avail, p))
            ranged = F.coalesce(F.try_element_at(up, F.lit(1)), default)
        return F.when(start.isNull(), default).otherwise(ranged)

    routed = _bind(murmur2(key), route)
    return F.when(F.col(key).isNull(), _null_key_slot(available, null_key_seed)).otherwise(routed).cast("int")


def priority_partition(key: str, amount: str, available: list[int] | None = None,
                       threshold: float = S.PRIORITY_THRESHOLD,
                       priority: int = S.PRIORITY_PARTITION, null_key_seed: int = 0) -> Column:
    """R-5: amount >= threshold -> the priority partition (if available);
    else md5(key) as a 128-bit integer mod the non-priority available
    partitions; null key or no such partition -> random available."""
    available = list(range(S.NUM_TOPIC_PARTITIONS)) if available is None else available
    others = [p for p in available if p != priority]
    rnd = F.element_at(F.array(*[F.lit(p) for p in available]),
                       (F.floor(F.rand(null_key_seed) * len(available)) + 1).cast("int"))
    if others:
        hashed = F.element_at(F.array(*[F.lit(p) for p in others]),
                              (md5_mod(key, F.lit(len(others))) + 1).cast("int"))
        normal = F.when(F.col(key).isNull(), rnd).otherwise(hashed)
    else:
        normal = rnd
    if priority in available:
        return F.when(F.coalesce(F.col(amount), F.lit(0)) >= F.lit(threshold), F.lit(priority)) \
                .otherwise(normal).cast("int")
    return normal.cast("int")


def partition_skew(df: DataFrame, partition: str = "partition") -> DataFrame:
    """R-6: messages per partition (a partial-aggregating count)."""
    return df.groupBy(partition).agg(F.count(F.lit(1)).alias("messages"))


def partition_balance(df: DataFrame, partition: str = "partition") -> DataFrame:
    """R-6 summary: partitions used, max / min / mean load and max/mean skew."""
    per = partition_skew(df, partition)
    return per.agg(F.count(F.lit(1)).alias("partitions"),
                   F.max("messages").alias("max_messages"),
                   F.min("messages").alias("min_messages"),
                   F.round(F.avg("messages"), 6).alias("avg_messages"),
                   F.round(F.max("messages") / F.avg("messages"), 6).alias("skew"))


def layout_by_partition(df: DataFrame, partition: Column, num_partitions: int) -> DataFrame:
    """Physically place rows in Spark partition = computed partition id."""
    return df.repartitionById(num_partitions, partition)
