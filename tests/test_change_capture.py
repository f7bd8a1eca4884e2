"""Snapshot and change log: whatever the reads saw inside their brackets, the result is the serial replay."""
import random

import pytest
from pyspark.sql import functions as F

from eventide.operators import change_capture as CC


def serial(log):
    table = {}
    for lsn, key, op, row in sorted(log):
        table[key] = None if op == "d" else row
    return table


@pytest.mark.parametrize("seed", range(4))
def test_any_interleaving_is_the_serial_replay(spark, seed):
    rng = random.Random(seed)
    log, alive = [], set()
    for lsn in range(1, 400):
        key = rng.randint(0, 39)
        op = "c" if key not in alive else rng.choice("uuud")
        (alive.discard if op == "d" else alive.add)(key)
        log.append((lsn, key, op, None if op == "d" else f"r{lsn}"))
    bounds, marks, snapshot = [10, 20, 30], [], []
    for chunk in range(4):
        if chunk == 3 and seed % 2:
            continue  # not read yet: the log alone
        low = rng.randint(0, 300)
        high = low + rng.randint(0, 99)
        marks.append((chunk, low, high))
        for key in range(10 * chunk, 10 * chunk + 10):  # each row is read at some moment of the bracket
            row = serial([x for x in log if x[0] <= rng.randint(low, high)]).get(key)
            if row is not None:
                snapshot.append((key, row))
    changes = spark.createDataFrame([(k, op, lsn, row) for lsn, k, op, row in log], "key long, op string, lsn long, row string")
    args = (spark.createDataFrame(snapshot, "key long, row string"), changes, spark.createDataFrame(marks, "chunk int, low long, high long"),
            CC.chunk_of(F.col("key"), bounds))
    want = serial(log)
    assert {r.key: r.row for r in CC.snapshot_and_changes(*args).collect()} == {k: v for k, v in want.items() if v is not None}
    kept = {r.key: r.row for r in CC.snapshot_and_changes(*args, with_tombstones=True).collect()}
    assert {k: v for k, v in want.items() if v is not None}.items() <= kept.items()
    assert all(want[k] is None for k, v in kept.items() if v is None)


def test_envelopes(spark):
    rows = [("1", '{"op":"u","before":"{\\"a\\":1}","after":"{\\"a\\":2}","ts_ms":5,"lsn":9}'), ("2", '{"op":"d","before":"{\\"a\\":3}","ts_ms":6,"lsn":10}'),
            ("3", None), ("4", "not json"), ("5", "{}")]
    got = {r.key: (r.op, r.lsn, r.before and r.before.a, r.row and r.row.a) for r in
           CC.parse_envelope(spark.createDataFrame(rows, "key string, value string"), "a int").collect()}
    assert got == {"1": ("u", 9, 1, 2), "2": ("d", 10, 3, None), "3": (None,) * 4, "4": (None,) * 4, "5": (None,) * 4}
    made = spark.createDataFrame([("k",)], "key string").select("key", CC.envelope(
        F.lit("c"), F.lit(None).cast("string"), F.lit('{"a":7}'), F.lit(1).cast("long"), F.lit(2).cast("long")).alias("value"))
    assert tuple(CC.parse_envelope(made, "a int").select("op", "lsn", "row.a").first()) == ("c", 2, 7)
