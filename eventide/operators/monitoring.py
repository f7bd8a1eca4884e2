"""A-5 .. A-10: counters, latency histogram, lag, rates, throughput, offsets.

Every metric is a group-by over the log (partial aggregation on the
mappers), so metric jobs scale with the log and never gather rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide import schemas as S

LATENCY_BUCKETS_MS = [5, 10, 25, 50, 100, 250, 500, 1000]


def log_counters(log: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """A-5: messages and value bytes per label set (default topic, partition)."""
    labels = labels or ["topic", "partition"]
    return log.groupBy(*labels).agg(F.count(F.lit(1)).alias("messages"),
                                    F.sum(F.length("value")).cast("long").alias("value_chars"))


def latency_histogram(df: DataFrame, latency_ms: str, by: list[str],
                      buckets: list[float] | None = None) -> DataFrame:
    """A-6: cumulative bucket counts (``le_<b>``), count and sum per group."""
    buckets = buckets or LATENCY_BUCKETS_MS
    aggs = [F.sum((F.col(latency_ms) <= b).cast("long")).alias(f"le_{b}") for b in buckets]
    aggs += [F.count(F.col(latency_ms)).alias("count"),
             F.sum(F.col(latency_ms).cast("decimal(18,2)")).alias("sum_ms")]
    return df.groupBy(*by).agg(*aggs)


def latency_quantiles(df: DataFrame, latency_ms: str, by: list[str],
                      quantiles: tuple[float, ...] = (0.5, 0.99), accuracy: int = 100_000) -> DataFrame:
    """A-6: p50 / p99 with a mergeable sketch (bounded memory per group)."""
    q = F.percentile_approx(latency_ms, list(quantiles), accuracy)
    out = df.groupBy(*by).agg(q.alias("__q"))
    return out.select(*by, *[F.col("__q")[i].alias(f"p{int(p * 100)}") for i, p in enumerate(quantiles)])


def next_offsets(log: DataFrame) -> DataFrame:
    """A-10: next offset to read per partition (last handled + 1)."""
    return log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))


def consumer_lag(log: DataFrame, committed: DataFrame, warning: int = S.LAG_WARNING,
                 critical: int = S.LAG_CRITICAL) -> DataFrame:
    """A-7: end offset - committed offset per partition, with severity.

    ``committed`` holds ``topic, partition, committed_offset`` (one row per
    partition).  Partitions without a commit have lag = end offset."""
    end = next_offsets(log).withColumnRenamed("next_offset", "end_offset")
    j = end.join(committed, ["topic", "partition"], "left")
    lag = F.col("end_offset") - F.coalesce(F.col("committed_offset"), F.lit(0))
    return j.select("topic", "partition", "end_offset",
                    F.coalesce(F.col("committed_offset"), F.lit(0)).alias("committed_offset"),
                    lag.alias("lag"),
                    F.when(lag > critical, F.lit("CRITICAL")).when(lag > warning, F.lit("WARNING"))
                     .otherwise(F.lit("OK")).alias("severity"))


def _seconds(window: str) -> Column:
    """Length of a window column, from its own bounds."""
    return F.timestamp_diff("SECOND", F.col(f"{window}.start"), F.col(f"{window}.end")).cast("decimal(10,0)")


def rate_alerts(events: DataFrame, ts: str, is_error: Column, window: str = "1 hour",
                error_rate_warning: float = S.ERROR_RATE_WARNING,
                events_per_min_warning: float = S.EVENT_RATE_WARNING_PER_MIN) -> DataFrame:
    """A-8: per window error rate (> 1 % WARNING) and event rate (> 1/min)."""
    g = events.groupBy(F.window(F.col(ts), window).alias("w")).agg(
        F.count(F.lit(1)).alias("events"), F.sum(is_error.cast("long")).alias("errors"))
    rate = (F.col("errors").cast("decimal(20,0)") / F.col("events")).cast("decimal(12,6)")
    per_min = (F.col("events").cast("decimal(18,0)") * 60 / _seconds("w")).cast("decimal(12,6)")
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "events", "errors", rate.alias("error_rate"), per_min.alias("events_per_min"),
                    (rate > F.lit(error_rate_warning)).alias("error_rate_warning"),
                    (per_min > F.lit(events_per_min_warning)).alias("event_rate_warning"))


def throughput(log: DataFrame, window: str = "1 hour", by: list[str] | None = None) -> DataFrame:
    """A-9: messages per second per window (and label)."""
    by = by or ["topic"]
    g = log.groupBy(F.window("timestamp", window).alias("w"), *by).agg(F.count(F.lit(1)).alias("messages"))
    return g.select(*by, F.col("w.start").alias("window_start"), "messages",
                    (F.col("messages").cast("decimal(20,0)") / _seconds("w")).cast("decimal(14,6)").alias("messages_per_sec"))
