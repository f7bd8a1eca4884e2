"""Keyed stream operators: any arrival within the delay gives the batch result; late rows, hot keys, state that goes.

Most tests drive a processor as Spark does (rows of a key by micro-batch, then
timers at or before the watermark) with states in dictionaries; the registered
queries run the same processors on Spark's own state store.
"""
import json
import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventide import schemas as S
from eventide.session import scratch_path
from eventide.streaming import keyed_state as KS
from eventide.streaming import pipelines as ST

SECOND = 1_000_000


class Value:
    def __init__(self):
        self.v = None

    def exists(self):
        return self.v is not None

    def get(self):
        return self.v

    def update(self, v):
        self.v = v


class Items(list):
    def get(self):
        return iter(list(self))

    def put(self, rows):
        self[:] = rows

    def appendList(self, rows):
        self.extend(rows)


class Map(dict):
    def getValue(self, k):
        return self.get(k)

    def updateValue(self, k, v):
        self[k] = v

    def removeKey(self, k):
        self.pop(k, None)

    def iterator(self):
        return iter(list(self.items()))


class Handle:
    def __init__(self):
        self.states, self.timers = {}, set()

    def getValueState(self, name, *kinds):
        return self.states.setdefault(name, Value())

    def getListState(self, name, *kinds):
        return self.states.setdefault(name, Items())

    def getMapState(self, name, *kinds):
        return self.states.setdefault(name, Map())

    def registerTimer(self, ms):
        self.timers.add(ms)


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def drive(processor, batches, delay_ms, key="k"):
    """Rows out of a processor for the micro-batches of one key, a no-data batch after each, and its handle."""
    handle, out, newest = Handle(), [], 0
    processor.init(handle)
    for rows in [*batches, None]:
        marks = [max(0, newest - delay_ms)]
        if rows is None:
            marks = [2**52]
        elif rows:
            frame = pd.DataFrame(rows)
            parts = np.array_split(np.arange(len(frame)), min(3, len(frame)))
            out += processor.handleInputRows((key,), iter([frame.iloc[p] for p in parts]), Clock(marks[0]))
            newest = max(newest, *(r["us"] // 1000 for r in rows))
            marks.append(max(0, newest - delay_ms))
        for mark in marks:
            for timer in sorted(t for t in handle.timers if t <= mark):
                handle.timers.discard(timer)
                out += processor.handleExpiredTimer((key,), Clock(mark), None)
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame(), handle


def shuffled(rng, rows, most_us, n_batches):
    """Rows in the order of arrival, each up to ``most_us`` late, cut into micro-batches."""
    arrived = sorted(rows, key=lambda r: r["us"] + rng.randint(0, most_us))
    cuts = sorted(rng.sample(range(1, len(arrived)), n_batches - 1))
    return [arrived[a:b] for a, b in zip([0, *cuts], [*cuts, len(arrived)])]


@pytest.mark.parametrize("seed", range(6))
def test_running_windows_in_any_order(seed):
    rng = random.Random(seed)
    rows = [{"order_id": f"o{i}", "us": rng.randint(1, 3600) * SECOND + rng.choice([0, 1, 999]), "cents": rng.choice([0, 150, 999]),
             "region": rng.choice([None, *S.REGIONS])} for i in range(120)]
    got, handle = drive(KS.RunningWindows(300 * SECOND), shuffled(rng, rows, 600 * SECOND, 7), 600_000)
    want, book = {}, {}
    for r in sorted(rows, key=lambda r: (r["us"], r["order_id"])):
        b = book.setdefault(r["us"] // (300 * SECOND), [0, 0, set()])
        b[0] += 1
        b[1] += r["cents"]
        b[2] |= {r["region"]} - {None}
        want[r["order_id"]] = (b[0], b[1], len(b[2]))
    assert not got["late"].any() and len(got) == len(rows)
    assert {r.order_id: (r.order_count, r.total_cents, r.region_count) for r in got.itertuples()} == want
    assert not handle.states["windows"] and not handle.timers  # windows that closed are gone


def test_late_orders_come_out_marked_and_count_nowhere():
    at = lambda i, s: {"order_id": f"o{i}", "us": s * SECOND, "cents": 100, "region": "us-east"}
    # after the first batch the watermark is 900 s: 900.000 is late, 900.001 is not
    batches = [[at(0, 1000)], [at(1, 900), {**at(2, 900), "us": 900 * SECOND + 1000}, at(3, 1500)], [at(4, 1000)]]
    got, _ = drive(KS.RunningWindows(600 * SECOND), batches, 100_000)
    assert {r.order_id: r.late for r in got.itertuples()} == {"o0": False, "o1": True, "o2": False, "o3": False, "o4": True}
    assert {r.order_id: r.order_count for r in got[~got["late"].astype(bool)].itertuples()} == {"o2": 1, "o0": 2, "o3": 1}


@pytest.mark.parametrize("seed", range(6))
def test_profiles_as_of_in_any_order(seed):
    rng = random.Random(seed)
    base = {"payload": None, "name": None, "email": None, "tier": None}
    rows = [{**base, "kind": "profile", "us": rng.randint(1, 400) * SECOND, "name": rng.choice(["n", None]), "email": f"e{rng.randint(0, 9)}",
             "tier": rng.choice(["a", "b", None])} for _ in range(40)]
    rows += [{**base, "kind": "order", "us": rng.randint(1, 400) * SECOND, "payload": json.dumps(i)} for i in range(80)]
    got, handle = drive(KS.ProfileAsOf(), shuffled(rng, rows, 50 * SECOND, 9), 50_000)
    low = lambda v: tuple((x is not None, x or "") for x in v)
    want = {}
    for r in rows:
        if r["kind"] == "order":
            seen = [(p["us"], low((p["email"], p["name"], p["tier"])), (p["email"], p["name"], p["tier"]))
                    for p in rows if p["kind"] == "profile" and p["us"] <= r["us"]]
            want[r["payload"]] = max(seen, key=lambda s: s[:2])[2] if seen else (None, None, None)
    have = {r.payload: tuple(KS._none((r.email, r.name, r.tier))) for r in got[["payload", "email", "name", "tier"]].itertuples(index=False)}
    assert have == want and not got["late"].any()
    assert len(handle.states["versions"]) == 1 and not handle.states["orders"]  # one version is left: the valid one


def test_late_profiles_and_orders():
    row = lambda kind, s, **kw: {"kind": kind, "us": s * SECOND, "payload": None, "name": None, "email": None, "tier": None, **kw}
    batches = [[row("profile", 10, email="p10"), row("order", 500, payload="o500")],
               # the watermark is 400 s now: both are late, o450 is not
               [row("profile", 300, email="p300"), row("order", 350, payload="o350"), row("order", 450, payload="o450")]]
    got, _ = drive(KS.ProfileAsOf(), batches, 100_000)
    told = {r.payload: (r.email, bool(r.late)) for r in got.itertuples() if r.kind == "order"}
    assert told == {"o500": ("p300", False), "o450": ("p300", False), "o350": (None, True)}
    assert [(r.email, r.late) for r in got.itertuples() if r.kind == "profile"] == [("p300", True)]
    got, _ = drive(KS.ProfileAsOf(), [[row("profile", 1, email="x"), row("order", 2, payload="o")]], 0, key=None)
    assert list(KS._none(got["email"])) == [None]  # a row without customer belongs to none


def test_a_million_requests_of_one_order_in_one_micro_batch():
    """Read batch by batch as numbers: under 150 MB for a million rows, and exact."""
    n, step = 1_000_000, 10_000
    statuses = np.array(S.ORDER_STATUSES, object)

    def batches():
        for lo in reversed(range(0, n, step)):  # the last ones come first
            i = np.arange(lo, lo + step)
            yield pd.DataFrame({"customer_id": "c", "event_id": i, "us": i // 7, "requested_status": statuses[i % 2]})
    own = KS.OrderStates({S.ORDER_STATUSES[0]: [S.ORDER_STATUSES[1]], S.ORDER_STATUSES[1]: [S.ORDER_STATUSES[0]]}, S.ORDER_STATUSES[0])
    handle = Handle()
    own.init(handle)
    handle.states["history"].appendList = lambda rows: None  # Spark keeps it on disk
    tracemalloc.start()
    seen = accepted = 0
    for frame in own.handleInputRows(("hot",), batches(), None):
        assert list(frame["event_id"]) == list(range(seen, seen + len(frame)))  # in order
        seen, accepted = seen + len(frame), accepted + int(frame["accepted"].sum())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == n and accepted == n - 1  # the first asks for the status it has
    assert peak < 150e6


def test_order_states_take_nulls_and_go_on():
    frame = lambda *rows: pd.DataFrame(rows, columns=["event_id", "us", "requested_status"]).assign(customer_id="c")
    own, handle = KS.OrderStates(S.VALID_TRANSITIONS, S.INITIAL_STATUS), Handle()
    own.init(handle)
    first = pd.concat(own.handleInputRows(("o",), iter([frame((2, 20, None), (1, 10, "paid")), frame((3, 5, "nonsense"))]), None))
    second = pd.concat(own.handleInputRows(("o",), iter([frame((4, 1, "fulfilled"))]), None))
    assert list(first["previous_status"]) == ["placed", "placed", "paid"] and list(first["accepted"]) == [False, True, False]
    assert list(second["previous_status"]) == ["paid"] and list(handle.states["history"]) == [("placed", "paid", 1, 10), ("paid", "fulfilled", 4, 1)]
    assert handle.states["status"].v == ("fulfilled",)


def test_windows_on_the_state_store_in_any_session_zone(spark):
    """Nulls, a session zone with summer time, and a state store that a heartbeat empties."""
    src, out, ckpt = (scratch_path(spark, n) for n in ("rz-src", "rz-out", "rz-ckpt"))
    schema = "order_id string, customer_id string, region string, amount decimal(12,2), placed_at timestamp_ntz"
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        values = ["('o1','c','a|b',1.00,timestamp_ntz'2024-03-10 02:00:01')", "('o3','c','a|b',null,timestamp_ntz'2024-03-10 02:02:00')",
                  "('o2','c',null,2.00,timestamp_ntz'2024-03-10 02:01:00'),('o4','c','b',4.00,null)",
                  "(null,null,null,null,timestamp_ntz'2100-01-01 00:00:00')"]
        for v in values:
            spark.sql(f"select * from values {v}").toDF("order_id", "customer_id", "region", "amount", "placed_at").selectExpr(
                "cast(order_id as string) order_id", "cast(customer_id as string) customer_id", "cast(region as string) region",
                "cast(amount as decimal(12,2)) amount", "cast(placed_at as timestamp_ntz) placed_at").write.mode("append").parquet(src)
            stream = KS.running_windows_stream(ST.file_stream(spark, src, spark.createDataFrame([], schema).schema), 300, 600)
            ST.run_until_caught_up(stream, ST.append_batches(out), ckpt)
        got = {r.order_id: (r.order_count, str(r.total_amount), r.region_count, str(r.window_start)) for r in ST.read_batches(spark, out).collect()}
        left = spark.read.format("statestore").option("stateVarName", "windows").load(ckpt).count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    start = "2024-03-10 02:00:00"
    assert got == {"o1": (1, "1.00", 1, start), "o2": (2, "3.00", 1, start), "o3": (3, "3.00", 1, start)}
    assert left == 0


def test_status_and_history_are_read_from_the_state_store(spark):
    src, out, ckpt = (scratch_path(spark, n) for n in ("sh-src", "sh-out", "sh-ckpt"))
    schema = "order_id string, customer_id string, event_id long, requested_status string, ts timestamp_ntz"
    for part in ([("a", 1, "paid"), ("b", 2, "shipped")], [("a", 3, "fulfilled"), ("a", 4, "paid")]):
        df = spark.createDataFrame([(o, "c", i, r, None) for o, i, r in part], schema).withColumn(
            "ts", F.timestamp_seconds(F.col("event_id")).cast("timestamp_ntz"))
        df.write.mode("append").parquet(src)
        ST.run_until_caught_up(KS.order_state_stream(ST.file_stream(spark, src, df.schema)), ST.append_batches(out), ckpt)
    assert {tuple(r) for r in KS.order_statuses(spark, ckpt).collect()} == {("a", "fulfilled"), ("b", "placed")}
    assert sorted((r.order_id, r.event_id, r.from_status, r.to_status) for r in KS.order_history(spark, ckpt).collect()) == [
        ("a", 1, "placed", "paid"), ("a", 3, "paid", "fulfilled")]


@pytest.mark.parametrize("seed", range(8))
def test_order_states_are_the_fold_of_all_batches(seed):
    """Any requests in any micro-batches: what each meets, and the status that is left."""
    rng = random.Random(seed)
    own, handle, got, event = KS.OrderStates(S.VALID_TRANSITIONS, S.INITIAL_STATUS), Handle(), [], 0
    own.init(handle)
    want, now = [], S.INITIAL_STATUS
    for _ in range(rng.randint(1, 6)):
        rows = [(event + i, rng.randint(0, 3), rng.choice([*S.ORDER_STATUSES, "payment_failed", "placed", "bogus", None])) for i in range(rng.randint(1, 12))]
        event += len(rows)
        for _, i, r in sorted(((us, i, r) for i, us, r in rows), key=lambda x: x[:2]):
            ok = r in S.VALID_TRANSITIONS.get(now, ())
            want.append((i, now, ok))
            now = r if ok else now
        rng.shuffle(rows)
        frame = pd.DataFrame(rows, columns=["event_id", "us", "requested_status"]).assign(customer_id="c")
        parts = [frame.iloc[:len(rows) // 2], frame.iloc[len(rows) // 2:]]
        for out in own.handleInputRows(("o",), iter([p for p in parts if len(p)]), None):
            got += list(zip(out["event_id"], out["previous_status"], out["accepted"]))
    assert [(i, p, bool(a)) for i, p, a in got] == want and handle.states["status"].v == (now,)
