"""Keyed stream operators on groups of many keys: each key's own results, state calls that do not grow with the keys."""
import json
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_keyed_state import SECOND, Clock, Handle, Items, Map, drive, shuffled

from eventide import schemas as S
from eventide.plans import queries as Q
from eventide.streaming import keyed_state as KS
from eventide.streaming import pipelines as ST


@pytest.mark.parametrize("seed", range(4))
def test_windows_of_many_customers(seed):
    rng = random.Random(seed)
    rows = [{"customer_id": rng.choice(["a", "b", "c", None]), "order_id": f"o{i}", "us": rng.randint(1, 3600) * SECOND,
             "cents": rng.choice([0, 150, 999]), "region": rng.choice([None, *S.REGIONS])} for i in range(300)]
    got, handle = drive(KS.RunningWindows(300 * SECOND), shuffled(rng, rows, 600 * SECOND, 7), 600_000)
    want, book = {}, {}
    for r in sorted(rows, key=lambda r: (r["us"], r["order_id"])):
        b = book.setdefault((r["customer_id"], r["us"] // (300 * SECOND)), [0, 0, set()])
        b[0] += 1
        b[1] += r["cents"]
        b[2] |= {r["region"]} - {None}
        want[r["order_id"]] = (r["customer_id"], b[0], b[1], len(b[2]))
    have = {r.order_id: (*KS._none([r.customer_id]), r.order_count, r.total_cents, r.region_count) for r in got.itertuples()}
    assert have == want and not handle.states["windows"] and not handle.timers


@pytest.mark.parametrize("seed", range(4))
def test_profiles_of_many_customers(seed):
    rng = random.Random(seed)
    one = lambda kind, **kw: {"kind": kind, "customer_id": rng.choice(["a", "b", "c", None]), "us": rng.randint(1, 400) * SECOND,
                              "payload": None, "name": None, "email": None, "tier": None, **kw}
    rows = [one("profile", email=f"e{i}") for i in range(60)] + [one("order", payload=json.dumps(i)) for i in range(150)]
    got, handle = drive(KS.ProfileAsOf(), shuffled(rng, rows, 50 * SECOND, 9), 50_000)
    want = {}
    for r in (r for r in rows if r["kind"] == "order"):
        seen = [(p["us"], p["email"]) for p in rows if p["kind"] == "profile" and p["us"] <= r["us"]
                and p["customer_id"] == r["customer_id"] is not None]
        want[r["payload"]] = max(seen)[1] if seen else None
    assert {r.payload: KS._none([r.email])[0] for r in got.itertuples()} == want and not handle.states["orders"]
    left = KS._unpacked([t for (t,) in handle.states["versions"]], KS._VERSIONS)
    assert not left["customer_id"].duplicated().any()  # the valid version of each


def test_orders_of_one_bucket_have_their_own_status():
    own, handle = KS.OrderStatesOfBucket(S.VALID_TRANSITIONS, S.INITIAL_STATUS), Handle()
    own.init(handle)
    frame = lambda *rows: pd.DataFrame(rows, columns=["order_id", "event_id", "us", "requested_status"]).assign(customer_id="c")
    first = pd.concat(own.handleInputRows((7,), iter([frame(("a", 2, 20, "fulfilled"), ("b", 3, 5, "nonsense")), frame(("a", 1, 10, "paid"))]), None))
    second = pd.concat(own.handleInputRows((7,), iter([frame(("b", 5, 1, "paid"), ("a", 4, 1, "paid"))]), None))
    told = {r.event_id: (r.order_id, r.previous_status, bool(r.accepted)) for r in pd.concat([first, second]).itertuples()}
    assert told == {1: ("a", "placed", True), 2: ("a", "paid", True), 3: ("b", "placed", False), 4: ("a", "fulfilled", False),
                    5: ("b", "placed", True)}
    assert dict(handle.states["status"]) == {("a",): ("fulfilled",), ("b",): ("paid",)}
    assert list(handle.states["history"]) == [("a", "placed", "paid", 1, 10), ("a", "paid", "fulfilled", 2, 20), ("b", "placed", "paid", 5, 1)]


@pytest.mark.parametrize("processor", [lambda: KS.RunningWindows(10**9 * SECOND), KS.ProfileAsOf])
def test_state_calls_do_not_grow_with_the_keys(processor, monkeypatch):
    calls = []
    for kind in (Items, Map):
        for name in ("get", "put", "appendList") if kind is Items else ("getValue", "updateValue", "removeKey"):
            real = getattr(kind, name)
            monkeypatch.setattr(kind, name, lambda self, *a, real=real: calls.append(1) or real(self, *a))

    def count(n):
        calls.clear()
        own, handle = processor(), Handle()
        own.init(handle)
        i = np.arange(n)
        frame = pd.DataFrame({"customer_id": [f"c{x}" for x in i], "us": 10**9 + i, "order_id": [f"o{x}" for x in i], "cents": 1,
                              "region": None, "kind": np.where(i % 2, "order", "profile"), "payload": "{}", "name": "n", "email": "e",
                              "tier": "t"})
        out = [*own.handleInputRows((0,), iter([frame]), Clock(0)), *own.handleExpiredTimer((0,), Clock(10**8), None)]
        assert sum(map(len, out)) >= n // 2
        return len(calls)
    assert count(2000) == count(20)


def test_slices_are_made_from_one_run_of_the_frame(spark):
    seen = spark.sparkContext.accumulator(0)

    def tell(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf
    df = spark.range(100).mapInPandas(tell, "id long").select(F.when(F.col("id") > 4, F.col("id")).alias("id"))
    assert [seen.value for _ in Q._stream_in_slices(spark, df, "id", "one-run", None, cuts=[20, 20, 50])] == [100] * 4


def test_slices_hold_all_rows_in_order(spark):
    got = []
    df = spark.range(100).select(F.when(F.col("id") > 4, F.col("id")).alias("id"))
    out, n = Q.scratch_path(spark, "sl-out"), 0
    for stream, ckpt in Q._stream_in_slices(spark, df, "id", "rows-in-order", None, cuts=[20, 50]):
        ST.run_until_caught_up(stream, ST.append_batches(out), ckpt)
        rows = [r.id for r in ST.read_batches(spark, out).select("id").collect()]
        got.append((len(rows) - n, max(r for r in rows if r is not None)))
        n = len(rows)
    assert got == [(20, 19), (30, 49), (50, 99)]
