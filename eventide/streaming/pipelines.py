"""Structured Streaming forms: T-3 .. T-7, T-4 + F-5; keyed state is in ``keyed_state``.

Sources are file-backed topics (Parquet folders; a Kafka source gives the
same log columns, see ``sources.topics.read_kafka``).  Sinks are Spark's
file sink, or ``foreachBatch`` writers that are replay-safe: a micro-batch
writes its own ``batch_id=`` folder with overwrite, so a re-run batch replaces
its output instead of duplicating it.  Checkpoints live under the shared
``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide import schemas as S
from eventide.functions.columns import instant_to_ntz, ntz_to_instant


def file_stream(spark: SparkSession, path: str, schema: T.StructType,
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def run_until_caught_up(stream: DataFrame, batch_fn: Callable[[DataFrame, int], None],
                        checkpoint: str, output_mode: str = "append") -> None:
    """Process everything available now, then stop (bounded run; a
    long-running job uses a processing-time trigger instead)."""
    q = (stream.writeStream.outputMode(output_mode).foreachBatch(batch_fn)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def append_batches(out_path: str) -> Callable[[DataFrame, int], None]:
    """Replay-safe sink: each micro-batch overwrites its own folder."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
    return write


def read_batches(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.parquet(out_path)


# T-4 / F-5 -------------------------------------------------------------------------
def run_exactly_once(stream: DataFrame, out_path: str, checkpoint: str) -> None:
    """Consume-transform-produce into Spark's file sink, everything available now.

    The sink's own log (``_spark_metadata``) commits a micro-batch with its
    offsets: a batch that dies is written again and a batch that is in the log
    is not, also when a new checkpoint replays it under the same number.
    """
    q = (stream.writeStream.outputMode("append").format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def read_committed(spark: SparkSession, out_path: str) -> DataFrame:
    """F-5: rows of committed batches.  Spark reads a sink folder by its log; other files in it are not seen."""
    return spark.read.parquet(out_path)


# T-3 ---------------------------------------------------------------------------------
def window_stats_stream(orders: DataFrame, window: str, delay: str = S.FRAUD_EXPIRY,
                        key: str = "customer_id", ts: str = "placed_at", amount: str = "amount",
                        region: str = "region") -> DataFrame:
    """Tumbling-window stats with a watermark: state for windows older than
    the watermark is dropped, rows later than it are ignored.  Use with
    output mode ``update`` and keep the last version per window."""
    t = orders.withColumn("__t", ntz_to_instant(F.col(ts))).withWatermark("__t", delay)
    g = t.groupBy(F.window("__t", window).alias("w"), F.col(key)).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum(amount).cast(S.MONEY_SUM).alias("total_amount"),
        F.collect_set(region).alias("__regions"))  # regions: a fixed enum, bounded set
    return g.select(key, instant_to_ntz(F.col("w.start")).alias("window_start"),
                    instant_to_ntz(F.col("w.end")).alias("window_end"), "order_count", "total_amount",
                    F.size("__regions").cast("long").alias("region_count"))


# T-5 ---------------------------------------------------------------------------------
def dedup_stream(log: DataFrame, keys: list[str], ts: str = "timestamp", delay: str = "30 minutes") -> DataFrame:
    """Drop re-sent copies (same keys) seen within the watermark delay."""
    t = log.withColumn("__t", ntz_to_instant(F.col(ts))).withWatermark("__t", delay)
    return t.dropDuplicatesWithinWatermark(keys).drop("__t")


# X-5 / A-9 live -------------------------------------------------------------------------
class ProgressLog:
    """StreamingQueryListener that keeps per-batch progress (rows, rate,
    batch duration) for throughput reporting; register with
    ``spark.streams.addListener(ProgressLog())``."""

    def __new__(cls):
        from pyspark.sql.streaming import StreamingQueryListener

        class _Listener(StreamingQueryListener):
            def __init__(self):
                self.progress = []

            def onQueryStarted(self, event):
                pass

            def onQueryProgress(self, event):
                p = event.progress
                self.progress.append({"batch_id": p.batchId, "rows": p.numInputRows,
                                      "rows_per_sec": p.processedRowsPerSecond,
                                      "duration_ms": p.batchDuration})

            def onQueryIdle(self, event):
                pass

            def onQueryTerminated(self, event):
                pass

        return _Listener()


# T-5 batch form ---------------------------------------------------------------------------
def dedup_batch(log: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Drop re-sent copies by log position (keep one row per key)."""
    return log.dropDuplicates(keys or ["topic", "partition", "offset"])


# T-7 streaming -------------------------------------------------------------------------------
def late_router_writer(state_path: str, out_path: str, dlq_path: str, ts: str, arrival: str,
                       delay_days: int) -> Callable[[DataFrame, int], None]:
    """Route late rows to a dead-letter folder as they arrive.

    A row is late when its event time is more than ``delay_days`` behind the
    newest event time seen before it (earlier batches, then earlier arrivals
    in this batch).  The newest time seen is carried as a one-row table
    versioned by batch id; inside a batch the running max is the chunked
    scan with one global key (split into chunks, never one task)."""
    from eventide.functions.scan import running_sums
    from eventide.sinks.files import read_snapshot, write_snapshot

    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prev = read_snapshot(spark, state_path, batch_id - 1) if batch_id > 0 else None
        prev_us = prev.first()["max_us"] if prev is not None else None  # one value
        src = batch.persist()
        try:
            us = F.timestamp_diff("MICROSECOND", epoch, F.col(ts))
            run = running_sums(src.withColumn("__all", F.lit(0)), ["__all"], [arrival], {"__max_us": us},
                               inclusive=False, agg="max", every_key=True)
            seen = F.greatest(F.col("__max_us"), F.lit(prev_us).cast("long")) if prev_us is not None \
                else F.col("__max_us")
            wm = F.timestamp_add("DAY", F.lit(-delay_days), F.timestamp_add("MICROSECOND", seen, epoch))
            marked = run.withColumn("watermark", wm).withColumn(
                "__late", F.coalesce(F.col(ts) < F.col("watermark"), F.lit(False))).drop("__all", "__max_us")
            marked.filter("__late").drop("__late").write.mode("overwrite").parquet(f"{dlq_path}/batch_id={batch_id}")
            marked.filter("not __late").drop("__late", "watermark").write.mode("overwrite") \
                .parquet(f"{out_path}/batch_id={batch_id}")
            top = src.agg(F.max(us).alias("max_us"))
            if prev is not None:
                top = top.unionByName(prev.select("max_us")).agg(F.max("max_us").alias("max_us"))
            write_snapshot(top, state_path, batch_id)
        finally:
            src.unpersist()
    return write
