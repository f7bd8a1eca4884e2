"""Order life cycle: edges, terminal states, fold (incl. split hot orders)."""
import random

from eventide import schemas as S
from eventide.functions import scan
from eventide.operators import state_machine as SM


def test_transition_table():
    assert "paid" in S.VALID_TRANSITIONS["placed"]
    assert "cancelled" in S.VALID_TRANSITIONS["placed"]
    assert "fulfilled" in S.VALID_TRANSITIONS["paid"]
    assert "shipped" not in S.VALID_TRANSITIONS["placed"]
    assert S.VALID_TRANSITIONS["delivered"] == []
    assert set(S.VALID_TRANSITIONS) == set(S.ORDER_STATUSES)


def _python_fold(rows):
    state, out = {}, {}
    for oid, eid, req in sorted(rows, key=lambda r: (r[0], r[1])):
        cur = state.get(oid, "placed")
        ok = req in S.VALID_TRANSITIONS.get(cur, [])
        out[eid] = (cur, ok)
        if ok:
            state[oid] = req
    return out


def _requests(spark, rows):
    return spark.createDataFrame(
        [(o, f"c-{o}", e, r, e) for o, e, r in rows],
        "order_id string, customer_id string, event_id long, requested_status string, ts long"
    ).selectExpr("order_id", "customer_id", "event_id", "requested_status",
                 "timestamp_millis(ts) :: timestamp_ntz as ts")


def test_state_changes_match_sequential_fold(spark):
    rng = random.Random(7)
    statuses = S.ORDER_STATUSES + ["bogus"]
    # one hot order with most rows, plus small ones
    rows = [("hot", i, rng.choice(statuses)) for i in range(400)]
    rows += [(f"o{i % 9}", 1000 + i, rng.choice(statuses)) for i in range(200)]
    exp = _python_fold(rows)
    df = _requests(spark, rows)
    for chunk in (7, 10_000):  # split hot order / not split
        folded = scan.fold_states(df, ["order_id"], ["ts", "event_id"], "requested_status",
                                  S.ORDER_STATUSES, S.VALID_TRANSITIONS, "placed", "prev",
                                  max_chunk_rows=chunk)
        got = {r.event_id: r.prev for r in folded.collect()}
        assert got == {e: v[0] for e, v in exp.items()}


def test_rejections_do_not_change_state(spark):
    rows = [("a", 1, "shipped"), ("a", 2, "paid"), ("a", 3, "placed"), ("a", 4, "fulfilled"),
            ("a", 5, "delivered"), ("a", 6, "shipped"), ("a", 7, "delivered"), ("a", 8, "cancelled")]
    res = SM.order_state_changes(_requests(spark, rows)).orderBy("event_id").collect()
    assert [(r.previous_status, r.accepted) for r in res] == [
        ("placed", False), ("placed", True), ("paid", False), ("paid", True),
        ("fulfilled", False), ("fulfilled", True), ("shipped", True), ("delivered", False)]
    assert res[0].reason == "Invalid: placed -> shipped"
    cur = SM.order_current_state(SM.order_state_changes(_requests(spark, rows))).first()
    assert (cur.current_status, cur.transitions, cur.requests) == ("delivered", 4, 8)


def test_seeded_fold_continues_previous_state(spark):
    rng = random.Random(11)
    rows = [("hot", i, rng.choice(S.ORDER_STATUSES)) for i in range(300)]
    rows += [(f"o{i % 5}", 1000 + i, rng.choice(S.ORDER_STATUSES)) for i in range(100)]
    exp = _python_fold(rows)
    first = [r for r in rows if r[1] % 1000 < 150]
    second = [r for r in rows if r[1] % 1000 >= 150]
    for chunk in (9, 10_000):
        f1 = scan.fold_states(_requests(spark, first), ["order_id"], ["ts", "event_id"], "requested_status",
                              S.ORDER_STATUSES, S.VALID_TRANSITIONS, "placed", "prev",
                              max_chunk_rows=chunk, state_after="after")
        from pyspark.sql import functions as F
        seed = f1.groupBy("order_id").agg(F.max_by("after", F.struct("ts", "event_id")).alias("state"))
        f2 = scan.fold_states(_requests(spark, second), ["order_id"], ["ts", "event_id"], "requested_status",
                              S.ORDER_STATUSES, S.VALID_TRANSITIONS, "placed", "prev",
                              max_chunk_rows=chunk, initial_states=seed)
        got = {r.event_id: r.prev for r in f1.collect()}
        got.update({r.event_id: r.prev for r in f2.collect()})
        assert got == {e: v[0] for e, v in exp.items()}
