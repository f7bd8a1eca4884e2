"""The reference's fixture records (FIXTURES.md part A) through our operators."""
from decimal import Decimal

from pyspark.sql import functions as F

from eventide import schemas as S
from eventide.operators import joins, partitioning as P, windows as W
from eventide.operators.transforms import order_wire
from eventide.sources import topics as TP


def _order_rows(spark, rows):
    return spark.createDataFrame(rows, S.ORDER_PLACED_V1)


def _item(pid, name, qty, price):
    return (pid, name, qty, Decimal(price))


def _ts(s="2024-01-01 10:00:00"):
    import datetime as dt
    return dt.datetime.fromisoformat(s)


def sample_order():
    return ("order-test-001", "cust-test-001", [_item("LAPTOP-001", "MacBook Pro", 1, "2499.99")],
            Decimal("2499.99"), "USD", "credit_card", "123 Test St", "us-east", _ts())


def high_value_order():
    return ("order-whale-001", "cust-whale", [_item("LUX-001", "Diamond Watch", 3, "9999.99")],
            Decimal("29999.97"), "USD", "credit_card", "1 Rich Rd", "us-west", _ts())


def test_sample_order_enrichment(spark):
    orders = _order_rows(spark, [sample_order(), high_value_order()])
    customers = spark.createDataFrame(
        [("cust-test-001", "test@example.com", "Test Customer", "us-east", "premium")],
        "customer_id string, email string, name string, region string, tier string")
    got = {r.order_id: r for r in joins.enrich_orders(orders, customers).collect()}
    a = got["order-test-001"]
    assert (a.customer_name, a.customer_email, a.customer_tier, a.is_high_value) == (
        "Test Customer", "test@example.com", "premium", True)
    assert len(a.items) == 1 and a.items[0].unit_price == Decimal("2499.99")
    miss = got["order-whale-001"]  # no profile: defaults
    assert (miss.customer_name, miss.customer_email, miss.customer_tier) == ("Unknown", "unknown@example.com", "standard")


def test_high_value_order_spends_over_the_limit(spark):
    o = _order_rows(spark, [high_value_order()]).select(
        "order_id", "customer_id", "region", F.col("total_amount").alias("amount"), "placed_at")
    # one order: count 1, one region, 29999.97 > 5000 -> score 0.3 < 0.4, no alert
    assert W.fraud_alerts(o, W.FraudRule()).count() == 0
    stats = W.order_window_stats(o).first()
    assert (stats.order_count, stats.total_amount, stats.region_count) == (1, Decimal("29999.97"), 1)


def test_order_batch_routing(spark):
    regions = S.REGIONS
    rows = [(f"order-batch-{i:04d}", f"cust-{i % 10}", regions[i % 5]) for i in range(100)]
    df = spark.createDataFrame(rows, "order_id string, customer_id string, region string")
    got = df.select("region", P.region_partition("customer_id", "region").alias("p")).collect()
    for r in got:
        lo, hi = S.REGION_PARTITION_RANGES[r.region]
        assert lo <= r.p <= hi


def test_seed_customers_cdc_snapshot_then_changes(spark):
    rows = [
        ("r", 1, "cust-001", '{"name": "Alice Johnson", "tier": "premium"}'),
        ("r", 1, "cust-002", '{"name": "Bob Smith", "tier": "standard"}'),
        ("r", 1, "cust-003", '{"name": "Carol Williams", "tier": "enterprise"}'),
        ("u", 2, "cust-002", '{"name": "Bob Smith", "tier": "premium"}'),
        ("d", 3, "cust-003", None),
    ]
    changes = spark.createDataFrame(rows, "op string, ts_ms long, key string, after string").withColumn("seq", F.lit(0))
    cur = {r.key: r for r in TP.cdc_apply(changes).collect()}
    assert set(cur) == {"cust-001", "cust-002"}
    assert '"premium"' in cur["cust-002"].after


def test_wire_projection(spark):
    w = order_wire(_order_rows(spark, [sample_order()])).first()
    assert w.total_amount == 2499.99 and isinstance(w.placed_at, int)
    assert w.items[0].unit_price == 2499.99
    assert w.placed_at == 1704103200000
