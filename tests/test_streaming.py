"""Streaming edge cases: watermark drops late rows, replay is idempotent."""
from decimal import Decimal

from pyspark.sql import functions as F

from eventide.session import scratch_path
from eventide.streaming import pipelines as ST


def _orders(spark, rows):
    return spark.createDataFrame(rows, "order_id string, customer_id string, region string, amount decimal(12,2), ts string") \
        .withColumn("placed_at", F.col("ts").cast("timestamp_ntz")).drop("ts")


def test_event_behind_watermark_is_dropped(spark):
    src, out, ckpt = (scratch_path(spark, n) for n in ("wm-src", "wm-out", "wm-ckpt"))
    first = _orders(spark, [("o1", "c", "us-east", Decimal("10.00"), "2024-01-01 12:00:00"),
                            ("o2", "c", "us-east", Decimal("10.00"), "2024-01-01 13:00:00")])
    # watermark after the first batch: 13:00 - 30 min = 12:30.  Spark drops a
    # late row when its window has closed (end <= watermark): o3's window
    # 11:00-12:00 is closed; o4's window 12:00-13:00 is still open.
    late = _orders(spark, [("o3", "c", "us-east", Decimal("10.00"), "2024-01-01 11:10:00"),
                           ("o4", "c", "us-east", Decimal("10.00"), "2024-01-01 12:45:00")])  # 15 min behind: kept
    schema = first.schema
    first.write.mode("append").parquet(src)
    stats = ST.window_stats_stream(ST.file_stream(spark, src, schema), "1 hour", delay="30 minutes")
    ST.run_until_caught_up(stats, ST.append_batches(out), ckpt, "update")
    late.write.mode("append").parquet(src)
    stats = ST.window_stats_stream(ST.file_stream(spark, src, schema), "1 hour", delay="30 minutes")
    ST.run_until_caught_up(stats, ST.append_batches(out), ckpt, "update")
    got = spark.read.parquet(out)
    last = {(str(r.window_start), r.batch_id): r.order_count for r in got.collect()}
    final_noon = max((b, c) for (w, b), c in last.items() if w.startswith("2024-01-01 12:00"))
    assert final_noon[1] == 2
    assert not any(w.startswith("2024-01-01 11:00") for (w, _b) in last)


def _log(spark, n):
    return spark.range(n).select(F.lit("t").alias("topic"), F.col("id").cast("string").alias("key"), F.col("id").alias("offset"))


def test_exactly_once_replay_has_no_duplicates(spark):
    """A second run under a lost checkpoint replays every batch: the sink has them already."""
    src, out = scratch_path(spark, "eo-src"), scratch_path(spark, "eo-out")
    log = _log(spark, 100).repartition(4)
    log.write.parquet(src)
    for run in range(2):
        stream = ST.file_stream(spark, src, log.schema, max_files_per_trigger=1)
        ST.run_exactly_once(stream.select("key", "offset"), out, scratch_path(spark, f"eo-ck{run}"))
    got = ST.read_committed(spark, out)
    assert got.count() == 100 and got.select("key").distinct().count() == 100


def test_files_of_an_uncommitted_batch_are_not_read(spark):
    src, out, ckpt = (scratch_path(spark, n) for n in ("eu-src", "eu-out", "eu-ck"))
    log = _log(spark, 10)
    log.write.parquet(src)
    ST.run_exactly_once(ST.file_stream(spark, src, log.schema).select("key"), out, ckpt)
    spark.range(5).select(F.lit("dead").alias("key")).write.mode("append").parquet(out)  # landed, never committed
    assert sorted(r.key for r in ST.read_committed(spark, out).collect()) == sorted(map(str, range(10)))
    _log(spark, 12).filter("offset >= 10").write.mode("append").parquet(src)  # the query goes on as if nothing were there
    ST.run_exactly_once(ST.file_stream(spark, src, log.schema).select("key"), out, ckpt)
    assert ST.read_committed(spark, out).count() == 12


def test_progress_listener_records_batches(spark):
    """X-5 / A-9 live: the listener sees every micro-batch and its row count."""
    import time
    src, out, ckpt = (scratch_path(spark, n) for n in ("pl-src", "pl-out", "pl-ckpt"))
    log = spark.range(50).select(F.col("id").cast("string").alias("key"))
    log.write.parquet(src)
    listener = ST.ProgressLog()
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(src)
        ST.run_until_caught_up(stream, ST.append_batches(out), ckpt)
        deadline = time.time() + 30  # listener events arrive asynchronously
        while sum(p["rows"] for p in listener.progress) < 50 and time.time() < deadline:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert sum(p["rows"] for p in listener.progress) == 50
    assert all(p["duration_ms"] >= 0 for p in listener.progress)


def test_kafka_wrappers_fail_clearly_without_the_package(spark):
    """S-1/K-1 on a broker need the Kafka data source; without it the
    wrappers fail at once with Spark's own message (no connection tried)."""
    import pytest
    from pyspark.errors import AnalysisException

    from eventide.sinks.files import write_kafka
    from eventide.sources.topics import read_kafka
    try:
        read_kafka(spark, "localhost:1", ["orders"])
    except AnalysisException as e:
        assert "kafka" in str(e).lower()
    else:  # pragma: no cover - only where the package is installed
        pytest.skip("Kafka data source present")
    log = spark.createDataFrame([("k", "v")], "key string, value string")
    with pytest.raises(AnalysisException):
        write_kafka(log, "localhost:1", topic="orders")


