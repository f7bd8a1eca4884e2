"""Delivery reports and counters that a running stream observes."""
from eventide.session import scratch_path
from eventide.streaming import observed as O
from eventide.streaming import pipelines as ST

SCHEMA = "topic string, key string, value string, partition int, offset long"


def test_counters_equal_a_batch_group_by(spark):
    """Three micro-batches, one scan: what passes is counted as it passes."""
    src, out = scratch_path(spark, "obs-src"), scratch_path(spark, "obs-out")
    for part in range(3):
        rows = [(["orders.placed", "orders.dlq", "nowhere", None][i % 4], f"k{i}", None if i == 7 else "v" * (i % 12), 0, 100 * part + i)
                for i in range(40 + part)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    stream = ST.file_stream(spark, src, spark.read.parquet(src).schema, max_files_per_trigger=1)
    log = O.run_observed(O.delivery_reports(stream, 8), "produced", O.produced_counters(), out, scratch_path(spark, "obs-ck"))
    got = {(r.metric, r.topic, r.label): r.value for r in O.counter_table(spark, log.totals("produced")).collect()}
    written = spark.read.parquet(out)
    want = {}
    for r in written.collect():
        topic = r.topic if r.topic in ("orders.placed", "orders.dlq") else "other"
        want["produced", topic, r.status] = want.get(("produced", topic, r.status), 0) + 1
        if r.error_type:
            want["produce_errors", topic, r.error_type] = want.get(("produce_errors", topic, r.error_type), 0) + 1
        assert (r.offset is None) == (r.status == "error") == (topic == "other" or len(r.value or "") > 8)
    assert got == want and len(log.seen) == 3 and sum(log.rows.values()) == written.count() == 123


def test_a_batch_that_runs_again_is_counted_once():
    class Progress:
        id, batchId, numInputRows, batchDuration = "q", 0, 5, 1
        observedMetrics = {}

    class Row(dict):
        def asDict(self):
            return dict(self)

    class Event:
        progress = Progress()
    log = O.CounterLog()
    for value in (5, 5):
        Event.progress.observedMetrics = {"produced": Row(a=value)}
        log.onQueryProgress(Event)
    assert log.totals("produced") == {"a": 5} and log.totals("other") == {}
