"""Error classification, retry attempts, dead letters (reference test intent)."""
import json

from pyspark.sql import functions as F

from eventide.operators import reliability as D
from eventide.operators.transforms import classify_error


def _classify(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    return [r.t for r in df.select(classify_error(F.col("n")).alias("t")).collect()]


def test_classification(spark):
    assert _classify(spark, ["TimeoutError", "JSONDecodeError", "RuntimeError", "ConnectionError",
                             "ValidationError", "ValueError"]) == [
        "timeout", "deserialization_error", "unknown", "timeout", "deserialization_error", "unknown"]


def _run(spark, fn, n_rows=1):
    df = spark.createDataFrame([(i,) for i in range(n_rows)], "event_id long")
    return D.process_with_retry(df, fn).collect()


def test_permanent_error_is_not_retried(spark):
    def fn(row):
        json.loads("{bad")

    r = _run(spark, fn)[0]
    assert (r.ok, r.attempts, r.error_type) == (False, 1, "deserialization_error")


def test_two_failures_then_success_takes_three_calls(spark):
    class Flaky:
        calls = 0

        def __call__(self, row):
            Flaky.calls += 1
            if Flaky.calls < 3:
                raise TimeoutError("slow")

    r = _run(spark, Flaky())[0]
    assert (r.ok, r.attempts, r.error_type) == (True, 3, None)


def test_unknown_errors_are_retried_to_the_limit(spark):
    def fn(row):
        raise RuntimeError("boom")

    r = _run(spark, fn)[0]
    assert (r.ok, r.attempts, r.error_type) == (False, 3, "unknown")


def test_rows_of_a_batch_keep_their_own_attempts(spark):
    def fn(row):
        if row["event_id"] == 1 or row["event_id"] == 2 and row["attempt"] < 2:
            raise ConnectionError(f"try {row['attempt']}")
        if row["event_id"] == 3:
            raise json.JSONDecodeError("bad", "", 0)

    got = {r.event_id: (r.ok, r.attempts, r.error_type, r.error_message) for r in _run(spark, fn, 5)}
    assert got[0] == got[4] == (True, 1, None, None) and got[2] == (True, 2, None, None)
    assert got[1] == (False, 3, "timeout", "try 3") and got[3][:3] == (False, 1, "deserialization_error")


def test_what_did_not_fail_has_no_class_and_is_not_driven_again(spark):
    assert _classify(spark, [None, "X"]) == [None, "unknown"]
    df = spark.sql("select 1L event_id, cast(null as string) error_name, 1 attempts, timestamp_ntz'2024-01-01 00:00:00' first_failure_at "
                   "union all select 2L, 'TimeoutError', 1, timestamp_ntz'2024-01-01 00:00:00'")
    due = D.redrive_due(df, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    assert [r.event_id for r in due.collect()] == [2]


def test_rates_follow_the_window(spark):
    from eventide.operators import monitoring as M
    log = spark.sql("select 't' topic, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) as timestamp, id % 2 = 0 bad from range(10)")
    assert float(M.throughput(log, window="1 minute").first().messages_per_sec) == 0.166667
    r = M.rate_alerts(log, "timestamp", F.col("bad"), window="30 seconds").first()
    assert float(r.events_per_min) == 20 and float(r.error_rate) == 0.5


def test_rule_outcomes_and_dead_letters(spark):
    rows = [(1, "TimeoutError", 2), (2, "TimeoutError", 3), (3, "SchemaError", 1), (4, None, 0)]
    df = spark.createDataFrame(rows, "event_id long, error_name string, fail_times int")
    out = {r.event_id: (r.ok, r.attempts) for r in D.process_outcomes(df).collect()}
    assert out == {1: (True, 3), 2: (False, 3), 3: (False, 1), 4: (True, 1)}
    summary = D.dlq_summary(D.process_outcomes(df)).first()
    assert (summary.processed, summary.dlq_count) == (2, 2)


def test_retry_schedule_backoff(spark):
    df = spark.sql("select 1L as event_id, timestamp_ntz'2024-01-01 00:00:00' as t")
    rows = D.retry_schedule(df, "t").orderBy("attempt").collect()
    assert [(r.attempt, r.backoff_ms) for r in rows] == [(2, 1000), (3, 2000)]
    assert str(rows[1].retry_at) == "2024-01-01 00:00:03"
