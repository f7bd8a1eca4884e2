"""T-2 by snapshots: functions compose, late hours change their own day, the plan reads the tail."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventide import schemas as S
from eventide.operators import state_snapshots as SS
from eventide.session import scratch_path

SCHEMA = "order_id string, event_id long, requested_status string, ts string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def fold(rows):
    out = {}
    for o, i, r, ts in sorted(rows, key=lambda x: (x[3] is not None, x[3] or "", x[1])):
        now, n, total = out.get(o, (S.INITIAL_STATUS, 0, 0))
        ok = r in S.VALID_TRANSITIONS.get(now, ())
        out[o] = (r if ok else now, n + ok, total + 1)
    return out


def draw(rng, n, orders=12, days=6):
    walk = [*S.ORDER_STATUSES, "payment_failed", "placed", None, "strange"]
    return [(rng.choice(["hot"] * 6 + [f"o{k}" for k in range(orders)]), i, rng.choice(walk),
             rng.choice([None] + [f"2024-01-{rng.randint(1, days):02d} {rng.randint(0, 23):02d}:{rng.randint(0, 59):02d}:00"] * 40))
            for i in range(n)]


def told(df):
    return {r.order_id: (r.current_status, r.transitions, r.requests) for r in df.collect()}


@pytest.mark.parametrize("seed, parts", [(1, 1), (2, 5), (3, 40)])
def test_snapshot_and_tail_give_the_fold_of_all(spark, seed, parts):
    """Whatever the cut and however an hour is split over tasks and batches."""
    rng = random.Random(seed)
    rows, path = draw(rng, 600), scratch_path(spark, "hours")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        SS.write_hours(frame(spark, rows), path)
        for cut in ("2024-01-01 00:00:00", "2024-01-03 07:00:00", "2024-02-01 00:00:00"):
            got = SS.current_state(SS.snapshot(SS.read_hours(spark, path, until=cut)), SS.read_hours(spark, path, since=cut))
            assert told(got) == fold(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_late_request_changes_its_day_alone(spark):
    rng = random.Random(4)
    rows, path = draw(rng, 200), scratch_path(spark, "hours-late")
    SS.write_hours(frame(spark, rows), path)
    files = lambda: {f for f in spark.read.parquet(path).inputFiles()}
    had = files()
    late = [("hot", 1000, "cancelled", "2024-01-02 03:04:05"), ("fresh", 1001, "paid", "2024-01-02 23:59:59")]
    day = [r for r in rows + late if r[3] and r[3].startswith("2024-01-02")]
    SS.write_hours(frame(spark, day), path)
    assert {f.split("/day=")[1][:10] for f in had ^ files()} == {"2024-01-02"}
    cut = "2024-01-04 00:00:00"
    got = SS.current_state(SS.snapshot(SS.read_hours(spark, path, until=cut)), SS.read_hours(spark, path, since=cut))
    assert told(got) == fold(rows + late)


def test_the_tail_opens_no_earlier_day(spark):
    path = scratch_path(spark, "hours-plan")
    SS.write_hours(frame(spark, draw(random.Random(5), 200)), path)
    tail = SS.read_hours(spark, path, since="2024-01-05 12:00:00")
    plan = tail._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "2024-01-05" in plan
    read = {r.f.split("/day=")[1][:10] for r in tail.select(F.input_file_name().alias("f")).distinct().collect()}
    assert read and min(read) >= "2024-01-05"


def test_runs_are_composed_in_order():
    """Pairwise composition of runs of any length is the fold, for every status before."""
    rng = np.random.default_rng(6)
    target, accepted = SS._tables(S.ORDER_STATUSES, S.VALID_TRANSITIONS)
    for n in (1, 2, 3, 64, 101):
        code = rng.integers(0, len(target), n)
        starts = np.unique(np.concatenate([[0], rng.integers(0, n, 4)]))
        got = SS._composed(target[code], accepted[code], starts)
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], n])):
            for s in range(len(S.ORDER_STATUSES)):
                now, count = s, 0
                for c in code[a:b]:
                    count, now = count + accepted[c, now], target[c, now]
                assert (got[0][k, s], got[1][k, s]) == (now, count)


def test_no_requests(spark):
    assert SS.snapshot(SS.hour_functions(frame(spark, [("a", 1, "paid", None)]).limit(0))).collect() == []
