"""DuckDB text of the domain views (same definitions as ``sources.views``).

``with_views(sql)`` prefixes a query with the CTEs it references (and their
dependencies), so each oracle string is self-contained.
"""

from __future__ import annotations

import re

from eventide import schemas as S
from eventide.sources import views as V


def _list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


REGIONS = _list(S.REGIONS)
METHODS = _list(S.PAYMENT_METHODS)
STATUSES = _list(S.ORDER_STATUSES)
TIERS = _list(V.TIERS)
ERRORS = "CAST(" + _list(V.ERROR_NAMES) + " AS VARCHAR[])"
CARRIERS = _list(V.CARRIERS)


def _money_cents(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(18,0)) / 100 AS DECIMAL(12,2))"


def _topic_case(col: str) -> str:
    whens = " ".join(f"WHEN '{t}' THEN '{topic}'" for t, topic in V.EVENT_TOPIC.items())
    return f"CASE {col} {whens} ELSE 'orders.placed' END"


def _tier_index() -> str:
    whens = " ".join(f"WHEN '{seg}' THEN {i}" for seg, i in V.SEGMENT_TIER.items())
    return f"CASE c_mktsegment {whens} ELSE 0 END"


VIEWS: dict[str, str] = {
    "orders_placed": f"""
SELECT 'order-' || CAST(o_orderkey AS VARCHAR) AS order_id,
       'cust-' || CAST(o_custkey AS VARCHAR) AS customer_id,
       {_money_cents('floor(o_totalprice)')} AS total_amount,
       'USD' AS currency,
       {METHODS}[CAST((o_orderkey // 5) % 5 AS INTEGER) + 1] AS payment_method,
       CAST(o_orderkey AS VARCHAR) || ' Market St' AS shipping_address,
       {REGIONS}[CAST(o_orderkey % 5 AS INTEGER) + 1] AS region,
       o_orderdate AS placed_at
FROM orders""",
    "order_items": f"""
SELECT 'order-' || CAST(l_orderkey AS VARCHAR) AS order_id,
       l_linenumber AS line_number,
       'PROD-' || CAST(l_partkey AS VARCHAR) AS product_id,
       p_name AS product_name,
       CAST(l_quantity AS INTEGER) AS quantity,
       {_money_cents('floor(l_extendedprice * 100 / l_quantity)')} AS unit_price
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "profile_updates": f"""
SELECT 'cust-' || CAST(c_custkey AS VARCHAR) AS customer_id,
       'customer' || CAST(c_custkey AS VARCHAR)
         || CASE WHEN v = 0 THEN '' ELSE '.v' || CAST(v AS VARCHAR) END || '@example.com' AS email,
       c_name AS name,
       {REGIONS}[n_regionkey + 1] AS region,
       {TIERS}[CAST(({_tier_index()} + v) % 3 AS INTEGER) + 1] AS tier,
       CAST(coalesce(cnt, 0) AS INTEGER) AS lifetime_orders,
       TIMESTAMP '{V.PROFILE_EPOCH}' + to_days(CAST(v * 800 + (c_custkey * 7) % 700 AS INTEGER)) AS updated_at
FROM (SELECT *, unnest(range({V.PROFILE_VERSIONS})) AS v FROM customer) c
LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN (SELECT o_custkey, count(*) AS cnt FROM orders GROUP BY o_custkey) oc ON c_custkey = oc.o_custkey""",
    "customer_profiles": """
SELECT customer_id, email, name, region, tier, lifetime_orders, updated_at
FROM profile_updates
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC) = 1""",
    "event_log": f"""
SELECT topic, key, value, "partition",
       CAST(row_number() OVER (PARTITION BY topic, "partition" ORDER BY event_id) - 1 AS BIGINT) AS "offset",
       "timestamp"
FROM (SELECT {_topic_case('event_type')} AS topic,
             'user-' || CAST(user_id AS VARCHAR) AS key,
             CASE WHEN event_id % 20 = 0 THEN 'not-json' ELSE props END AS value,
             CAST(user_id % {S.NUM_TOPIC_PARTITIONS} AS INTEGER) AS "partition",
             event_id, ts AS "timestamp"
      FROM events) e""",
    "fraud_orders": f"""
SELECT 'evt-' || CAST(event_id AS VARCHAR) AS order_id, event_id,
       'cust-' || CAST(user_id AS VARCHAR) AS customer_id,
       {REGIONS}[CAST(event_id % 5 AS INTEGER) + 1] AS region,
       {_money_cents('round(value * 100)')} AS amount,
       ts AS placed_at
FROM events""",
    "state_requests": f"""
SELECT 'order-' || CAST(user_id AS VARCHAR) AS order_id,
       'cust-' || CAST(user_id AS VARCHAR) AS customer_id,
       event_id,
       {STATUSES}[CAST(event_id % 7 AS INTEGER) + 1] AS requested_status,
       ts
FROM events""",
    "failures": f"""
SELECT event_id, {_topic_case('event_type')} AS topic,
       CAST(user_id % {S.NUM_TOPIC_PARTITIONS} AS INTEGER) AS "partition",
       'user-' || CAST(user_id AS VARCHAR) AS key,
       props AS value,
       {ERRORS}[CAST(event_id % 8 AS INTEGER) + 1] AS error_name,
       CAST(CASE WHEN {ERRORS}[CAST(event_id % 8 AS INTEGER) + 1] IS NULL THEN 0 ELSE event_id % 5 END AS INTEGER) AS fail_times,
       CAST(event_id % 3 + 1 AS INTEGER) AS attempts,
       ts AS first_failure_at
FROM events""",
    "shipments": f"""
SELECT 'ship-' || CAST(l_orderkey AS VARCHAR) AS shipment_id,
       'order-' || CAST(l_orderkey AS VARCHAR) AS order_id,
       'cust-' || CAST(o_custkey AS VARCHAR) AS customer_id,
       {CARRIERS}[CAST(l_orderkey % 4 AS INTEGER) + 1] AS carrier,
       'TRK' || CAST(l_orderkey AS VARCHAR) AS tracking_number,
       created_at + INTERVAL 5 DAY AS estimated_delivery,
       items_count, qty * 0.5 AS weight_kg, created_at
FROM (SELECT l_orderkey, CAST(count(*) AS INTEGER) AS items_count, max(l_shipdate) AS created_at,
             sum(l_quantity) AS qty
      FROM lineitem GROUP BY l_orderkey) li
JOIN orders ON l_orderkey = o_orderkey""",
}

_DEPS = {
    "customer_profiles": ["profile_updates"],
}


def _needed(sql: str) -> list[str]:
    found = [n for n in VIEWS if re.search(rf"\b{n}\b", sql)]
    out: list[str] = []

    def add(n):
        for d in _DEPS.get(n, []):
            add(d)
        if n not in out:
            out.append(n)
    for n in found:
        add(n)
    return out


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the view CTEs it mentions (plus ``extra`` CTEs,
    which may use the views and are emitted after them, in order)."""
    extra = extra or {}
    text = sql + " ".join(extra.values())
    names = _needed(text)
    ctes = [f"{n} AS ({VIEWS[n]}\n)" for n in names]
    ctes += [f"{n} AS ({body}\n)" for n, body in extra.items()]
    if not ctes:
        return sql
    return "WITH " + ",\n".join(ctes) + "\n" + sql


VIEWS["order_lines"] = """
SELECT order_id AS line_order, count(*) AS n,
       string_agg(concat_ws('|', product_id, product_name, CAST(quantity AS VARCHAR), CAST(CAST(unit_price * 100 AS BIGINT) AS VARCHAR)), ';'
                  ORDER BY line_number, product_id, product_name, quantity, unit_price) AS lines,
       string_agg('{' || concat_ws(',', '"product_id":' || to_json(product_id)::VARCHAR, '"product_name":' || to_json(product_name)::VARCHAR,
                                   '"quantity":' || CAST(quantity AS VARCHAR), '"unit_price":' || CAST(unit_price AS VARCHAR)) || '}', ','
                  ORDER BY line_number, product_id, product_name, quantity, unit_price) AS json_lines
FROM order_items GROUP BY order_id"""
VIEWS["orders_with_items"] = """
SELECT orders_placed.*, CAST(coalesce(n, 0) AS INTEGER) AS item_count, coalesce(lines, '') AS items,
       '[' || coalesce(json_lines, '') || ']' AS items_json
FROM orders_placed LEFT JOIN order_lines ON order_id = line_order"""
VIEWS["orders_v1"] = """
SELECT * EXCLUDE (items_json) FROM orders_with_items WHERE CAST(substr(order_id, 7) AS BIGINT) % 2 = 0"""
VIEWS["orders_v2"] = """
SELECT p.* EXCLUDE (items_json), CASE WHEN o_orderkey % 3 = 0 THEN 'SAVE' || CAST(o_orderkey % 50 AS VARCHAR) END AS coupon_code,
       CASE WHEN starts_with(o_orderpriority, '1') THEN 'high' ELSE 'standard' END AS priority,
       o_orderpriority
FROM orders_with_items p JOIN orders ON p.order_id = 'order-' || CAST(o_orderkey AS VARCHAR)
WHERE o_orderkey % 2 = 1"""
VIEWS["sparse_orders"] = """
SELECT order_id, customer_id, total_amount,
       CASE WHEN k % 3 = 0 THEN NULL ELSE currency END AS currency,
       CASE WHEN k % 4 = 0 THEN NULL ELSE payment_method END AS payment_method,
       CASE WHEN k % 7 = 0 THEN NULL ELSE shipping_address END AS shipping_address,
       CASE WHEN k % 11 = 0 THEN 'mars' WHEN k % 13 = 0 THEN NULL ELSE region END AS region,
       placed_at
FROM (SELECT *, CAST(substr(order_id, 7) AS BIGINT) AS k FROM orders_placed) o"""
VIEWS["customer_changes"] = """
SELECT CASE WHEN updated_at < TIMESTAMP '1996-06-01 00:00:00' THEN 'c'
            WHEN CAST(substr(customer_id, 6) AS BIGINT) % 7 = 0 AND updated_at >= TIMESTAMP '2000-01-01 00:00:00' THEN 'd'
            ELSE 'u' END AS op,
       customer_id AS key, name, email, region, tier, epoch_ms(updated_at) AS ts_ms, 0 AS seq
FROM profile_updates"""
_DEPS.update({"order_lines": ["order_items"], "orders_with_items": ["orders_placed", "order_lines"],
              "orders_v1": ["orders_with_items"], "orders_v2": ["orders_with_items"],
              "sparse_orders": ["orders_placed"], "customer_changes": ["profile_updates"]})
