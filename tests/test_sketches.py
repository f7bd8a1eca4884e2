"""Sketches: rank errors at three sizes, and heavy keys with their guaranteed errors."""
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from eventide.operators import sketches as K
from eventide.session import scratch_path


@pytest.mark.parametrize("n", [3_000, 60_000, 400_000])
def test_rank_error_of_merged_hours(spark, n):
    """Exact while a range has no more values than the sketch; within 3 / k of the ranks beyond."""
    path, k = scratch_path(spark, "sketches"), 4096
    df = spark.range(n).select(
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id") % 72)).alias("ts"),
        (F.pow(F.pmod(F.xxhash64("id"), F.lit(100_003)) / 1000, 1.7)).alias("ms"), (F.col("id") % 2).alias("kind"))
    K.latency_sketches(df, "ts", "ms", ["kind"], k).write.partitionBy("day").parquet(path)
    got = K.quantiles_of_range(spark.read.parquet(path), "2024-01-01 12:00:00", "2024-01-03 06:00:00", ["kind"],
                               {"p50": 0.5, "p90": 0.9, "p99": 0.99}, k).collect()
    rows = df.filter("ts >= '2024-01-01 12:00:00' and ts < '2024-01-03 06:00:00'").toPandas()
    assert len(got) == 2
    for r in got:
        own = rows[rows["kind"] == r["kind"]]
        assert r["values"] == len(own)
        values = np.sort(own["ms"].to_numpy())
        for name, q in (("p50", 0.5), ("p90", 0.9), ("p99", 0.99)):
            if len(values) <= k:
                assert r[name] == duckdb.sql(f"select quantile_disc(ms, {q}) from own").fetchall()[0][0]
            else:
                rank = np.searchsorted(values, r[name], side="right") / len(values)
                assert abs(rank - q) <= 3 / k


def test_stored_sketches_prune_days(spark):
    path = scratch_path(spark, "sketch-days")
    df = spark.sql("select timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id as int)) ts, cast(id as double) ms, 'a' kind from range(96)")
    K.latency_sketches(df, "ts", "ms", ["kind"]).write.partitionBy("day").parquet(path)
    got = K.quantiles_of_range(spark.read.parquet(path), "2024-01-02 00:00:00", "2024-01-02 12:00:00", ["kind"], {"p50": 0.5})
    assert "PartitionFilters: [isnotnull(day" in got._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in got.collect()] == [("a", 12, 29.0)]


@pytest.mark.parametrize("seed, k", [(1, 4), (2, 20), (3, 400)])
def test_heavy_keys(spark, seed, k):
    rng = random.Random(seed)
    keys = [rng.choice(["hot", None] + [f"k{int(rng.expovariate(0.05))}" for _ in range(3)]) for _ in range(4000)]
    log = spark.createDataFrame([(x,) for x in keys], "customer string").repartition(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        true = Counter(x for x in keys if x is not None)
        total = sum(true.values())
        told = {r["key"]: (r["at_least"], r["at_most"]) for r in K.heavy_key_summary(log, "customer", k).collect()}
        assert all(lo <= true[x] <= hi for x, (lo, hi) in told.items())  # the guaranteed bounds
        assert all(hi - lo <= total / (k + 1) for lo, hi in told.values())
        assert {x for x, n in true.items() if n > total / (k + 1)} <= set(told)
        got = {r["key"]: r["rows"] for r in K.heavy_keys(log, "customer", k).collect()}
        assert got == {x: n for x, n in true.items() if n > total // (k + 1)}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_even_partitions(spark):
    """Heavy keys that share a partition are set apart; rows of a key stay together."""
    rows = [(f"h{i % 4}",) for i in range(4000)] + [(f"s{i}",) for i in range(400)] + [(None,)] * 5
    log = spark.createDataFrame(rows, "customer string")
    default = F.when(F.col("customer").startswith("h"), F.lit(0)).otherwise(F.coalesce(F.pmod(F.xxhash64("customer"), F.lit(4)), F.lit(0)).cast("int"))
    got = K.even_partitions(log, "customer", default, 9, 4)
    loads = {r["partition"]: r["count"] for r in got.groupBy("partition").count().collect()}
    before = {r["p"]: r["count"] for r in log.groupBy(default.alias("p")).count().collect()}
    assert max(before.values()) > 4000 and max(loads.values()) < 1.1 * min(loads.values()) and sum(loads.values()) == len(rows)
    assert got.filter("customer is not null").groupBy("customer").agg(F.count_distinct("partition").alias("n")).filter("n > 1").count() == 0
    assert got.columns == ["customer", "partition"]


def test_heaviest_first():
    assert K.balanced_assignment([("a", 5), ("b", 9), ("c", 5), ("d", 1)], [0, 3]) == {"b": 0, "a": 1, "c": 1, "d": 0}
