"""Edge rows: thresholds, ties, corrupt JSON, empty input, hot keys."""
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventide.functions import scan
from eventide.operators import joins, windows as W
from eventide.sources import topics as TP
from eventide import schemas as S


def test_high_value_is_strict_and_null_is_zero(spark):
    df = spark.createDataFrame([(Decimal("500.00"),), (Decimal("500.01"),), (None,)], "a decimal(12,2)")
    assert [r.h for r in df.select(joins.high_value(F.col("a")).alias("h")).collect()] == [False, True, False]


def _orders(spark, rows):
    return spark.createDataFrame(rows, "order_id string, customer_id string, region string, amount decimal(12,2), ts string") \
        .withColumn("placed_at", F.col("ts").cast("timestamp_ntz")).drop("ts")


def test_fraud_thresholds_are_strict(spark):
    rule = W.FraudRule(window="5 minutes")
    # exactly 10 orders, exactly 3 regions, exactly 5000.00: no alert
    rows = [(f"o{i:02d}", "c", ["us-east", "us-west", "apac"][i % 3], Decimal("500.00"), "2024-01-01 00:00:00")
            for i in range(10)]
    assert W.fraud_alerts(_orders(spark, rows), rule).count() == 0
    rows.append(("o10", "c", "eu-west", Decimal("0.01"), "2024-01-01 00:01:00"))
    alert = W.fraud_alerts(_orders(spark, rows), rule).collect()
    assert len(alert) == 1
    a = alert[0]
    assert (a.order_count, a.region_count, a.risk_score) == (11, 4, 1.0)
    assert a.reason == "high_freq:11; high_spend:$5000; multi_region:4"


def test_alert_windows_are_tumbling(spark):
    rows = [(f"o{i}", "c", "us-east", Decimal("3000.00"), f"2024-01-01 00:0{4 + i}:59") for i in range(2)]
    # 00:04:59 and 00:05:59 are in different 5-minute windows: no spend alert
    assert W.fraud_alerts(_orders(spark, rows), W.FraudRule()).count() == 0


def test_decode_json_flags_corrupt_rows(spark):
    log = spark.createDataFrame([('{"order_id": "a", "total_amount": 1.5}',), ("not-json",), ("123",), (None,)],
                                "value string")
    got = [r.decoded for r in TP.decode_json(log, S.ORDER_PLACED_V1).collect()]
    assert got == [True, False, False, False]


def test_empty_input(spark):
    empty = _orders(spark, []).limit(0)
    assert W.fraud_alerts(empty, W.FraudRule()).count() == 0
    assert scan.running_sums(empty, ["customer_id"], ["placed_at", "order_id"], {"n": F.lit(1)}).count() == 0


def test_hot_key_running_sums_split_into_chunks(spark):
    # one key holds most rows; equal timestamps tie-broken by id
    rows = [("hot", i, i // 3) for i in range(3000)] + [(f"k{i % 50}", 10_000 + i, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "k string, id long, t long")
    w = Window.partitionBy("k").orderBy("t", "id")
    exp = {r.id: (r.c, r.m) for r in df.select("id", F.count(F.lit(1)).over(w).alias("c"),
                                              F.max("id").over(w).alias("m")).collect()}
    for chunk in (97, 1_000_000):
        got = scan.running_sums(df, ["k"], ["t", "id"], {"c": F.lit(1).cast("long")}, max_chunk_rows=chunk)
        got_m = scan.running_sums(df, ["k"], ["t", "id"], {"m": "id"}, max_chunk_rows=chunk, agg="max")
        c = {r.id: r.c for r in got.collect()}
        m = {r.id: r.m for r in got_m.collect()}
        assert c == {i: v[0] for i, v in exp.items()}
        assert m == {i: v[1] for i, v in exp.items()}


def test_eos_transform_non_numeric_amount_counts_as_zero(spark):
    from eventide.operators.transforms import eos_transform
    df = spark.createDataFrame([("a", "600.5", "2024-01-01 00:00:00"), ("b", "abc", "2024-01-01 00:00:00"),
                                ("c", None, "2024-01-01 00:00:00")], "order_id string, total_amount string, placed_at string")
    got = {r.order_id: r.is_high_value for r in eos_transform(df).collect()}
    assert got == {"a": True, "b": False, "c": False}


def test_unknown_payment_method_is_a_violation(spark):
    from eventide.operators.transforms import order_rules, validate
    df = spark.createDataFrame([("o", "c", Decimal("1.00"), "USD", "barter", "us-east")],
                               "order_id string, customer_id string, total_amount decimal(12,2), currency string, "
                               "payment_method string, region string")
    r = validate(df.withColumn("items_quantity_ok", F.lit(True)).withColumn("items_price_ok", F.lit(True)),
                 order_rules()).first()
    assert (r.valid, r.violations) == (False, ["payment_method_enum"])


def test_hot_key_with_one_timestamp_is_split_by_id(spark):
    rows = [("hot", i, 0) for i in range(500)] + [("cold", 1000 + i, i) for i in range(20)]
    df = spark.createDataFrame(rows, "k string, id long, t long")
    whole, split = scan.split_hot(df, ["k"], ["t", "id"], max_chunk_rows=50)
    sizes = {(r.k, r["__chunk"]): r["count"] for r in split.groupBy("k", "__chunk").count().collect()}
    assert {k for k, _ in sizes} == {"hot"} and max(sizes.values()) <= 50
    assert whole.select("k").distinct().collect()[0].k == "cold"
    got = scan.running_sums(df, ["k"], ["t", "id"], {"c": F.lit(1).cast("long")}, max_chunk_rows=50)
    assert {r.id: r.c for r in got.filter("k = 'hot'").collect()} == {i: i + 1 for i in range(500)}


@pytest.mark.parametrize("agg", ["sum", "max", "last"])
def test_scans_do_not_depend_on_where_a_key_is_cut(spark, agg):
    """Null times, bursts at one time, text ties and null keys: the same for any chunk size."""
    rows = [("hot", None if i % 9 == 0 else (5 if i < 250 else i * i), f"id{(i * 37) % 400:03d}", None if i % 3 else i) for i in range(400)]
    rows += [(None, i % 4, f"n{i:03d}", i) for i in range(60)] + [("far", 10**12, "z", 1)]
    df = spark.createDataFrame(rows, "k string, t long, id string, v long")
    value = {"x": F.coalesce("v", F.lit(0)) if agg == "sum" else F.col("v")}
    want = None
    for chunk in (10**6, 100, 7):
        for inclusive in (True, False):
            got = scan.running_sums(df, ["k"], ["t", "id"], value, max_chunk_rows=chunk, inclusive=inclusive, agg=agg)
            own = {(r.k, r.id): r.x for r in got.collect()}
            assert len(own) == len(rows)
            if chunk == 10**6:
                want = {**(want or {}), inclusive: own}
            assert own == want[inclusive]
    every = scan.running_sums(df, ["k"], ["t", "id"], value, agg=agg, every_key=True)
    assert {(r.k, r.id): r.x for r in every.collect()} == want[True]


def test_fold_with_null_keys_and_times(spark):
    from eventide import schemas as S
    steps = ["confirmed", "shipped", "bogus", "delivered", "cancelled", "placed"]
    rows = [(k, None if i % 5 == 0 else i // 4, i, steps[(i * 7) % 6]) for k in (1, None) for i in range(80)]
    df = spark.createDataFrame(rows, "k long, t long, id long, q string")
    own = [{(r.k, r.id): (r.b, r.a) for r in scan.fold_states(
        df, ["k"], ["t", "id"], "q", S.ORDER_STATUSES, S.VALID_TRANSITIONS, S.INITIAL_STATUS, "b",
        max_chunk_rows=chunk, state_after="a").collect()} for chunk in (10**6, 9)]
    assert own[0] == own[1] and len(own[0]) == len(rows)
    assert [v for (k, _), v in sorted(own[0].items(), key=repr) if k is None] == [v for (k, _), v in sorted(own[0].items(), key=repr) if k == 1]


def test_decode_keeps_rows_with_a_bad_amount_and_refuses_trailing_text(spark):
    rows = [(1, '{"order_id":"a","total_amount":"abc"}'), (2, '{"order_id":"b","total_amount":12.5} '), (3, '{"order_id":"c"} x'),
            (4, "not-json"), (5, None), (6, '{"order_id":"d","total_amount":"7.25","items":[{"product_id":"p","unit_price":1.5},null]}')]
    got = {r.k: r for r in TP.decode_json(spark.createDataFrame(rows, "k int, value string"), S.ORDER_PLACED_V1).collect()}
    assert {k: r.decoded for k, r in got.items()} == {1: True, 2: True, 3: False, 4: False, 5: False, 6: True}
    assert [got[k].total_amount for k in (1, 2, 6)] == [None, Decimal("12.50"), Decimal("7.25")]
    assert got[6]["items"][0].unit_price == Decimal("1.50") and got[6]["items"][0].quantity is None and got[1]["items"] is None


def test_nested_items_total_and_rules(spark):
    from eventide.operators.transforms import nested_item_rules, nested_order_total, validate
    item = "array<struct<product_id:string,product_name:string,quantity:int,unit_price:decimal(12,2)>>"
    rows = [("a", [("p", "n", 2, Decimal("1.50")), ("q", "m", 1, Decimal("4.00"))]), ("b", [("p", "n", 0, Decimal("1.00"))]), ("c", None)]
    df = spark.createDataFrame(rows, f"order_id string, items {item}")
    total = {r.order_id: r.t for r in df.select("order_id", nested_order_total().alias("t")).collect()}
    assert total["a"] == Decimal("7.00") and total["b"] == 0
    bad = {r.order_id: r.violations for r in validate(df, nested_item_rules()).collect()}
    assert bad == {"a": [], "b": ["item_quantity_positive"], "c": []}
