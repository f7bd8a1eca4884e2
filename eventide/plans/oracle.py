"""DuckDB oracle SQL for each registered query (same column names)."""

from __future__ import annotations

from eventide import schemas as S
from eventide.plans.oracle_views import with_views

ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str, extra: dict[str, str] | None = None) -> None:
    ORACLE[name] = with_views(sql, extra)


oracle("enrich_orders", f"""
SELECT o.order_id, o.customer_id,
       coalesce(p.name, '{S.UNKNOWN_CUSTOMER_NAME}') AS customer_name,
       coalesce(p.email, '{S.UNKNOWN_CUSTOMER_EMAIL}') AS customer_email,
       coalesce(p.tier, 'standard') AS customer_tier,
       o.item_count, o.items, o.total_amount, o.currency,
       coalesce(o.total_amount, 0) > {S.HIGH_VALUE_THRESHOLD} AS is_high_value,
       o.region, o.placed_at, o.placed_at AS enriched_at
FROM orders_with_items o LEFT JOIN customer_profiles p ON o.customer_id = p.customer_id""")

oracle("compact_latest", "SELECT * FROM customer_profiles")


# --- fraud windows ---------------------------------------------------------
from eventide.operators.windows import SCALED_RULE as R  # noqa: E402

_W = "INTERVAL '5 days'"
_FRAUD_BASE = {
    "fw": f"""SELECT *, time_bucket({_W}, placed_at, TIMESTAMP '1970-01-01') AS window_start,
       time_bucket({_W}, placed_at, TIMESTAMP '1970-01-01') + {_W} AS window_end FROM fraud_orders""",
}


def _score_sql(c: str, a: str, r: str) -> tuple[str, str]:
    score = (f"least(0.0::DOUBLE + CASE WHEN {c} > {R.max_orders} THEN {S.FRAUD_WEIGHT_FREQ}::DOUBLE ELSE 0.0::DOUBLE END"
             f" + CASE WHEN {a} > {R.max_amount} THEN {S.FRAUD_WEIGHT_SPEND}::DOUBLE ELSE 0.0::DOUBLE END"
             f" + CASE WHEN {r} > {R.max_regions} THEN {S.FRAUD_WEIGHT_REGIONS}::DOUBLE ELSE 0.0::DOUBLE END, 1.0::DOUBLE)")
    reason = ("concat_ws('; ', "
              f"CASE WHEN {c} > {R.max_orders} THEN 'high_freq:' || CAST({c} AS VARCHAR) END, "
              f"CASE WHEN {a} > {R.max_amount} THEN 'high_spend:$' || CAST(CAST(round_even({a}, 0) AS BIGINT) AS VARCHAR) END, "
              f"CASE WHEN {r} > {R.max_regions} THEN 'multi_region:' || CAST({r} AS VARCHAR) END)")
    return score, reason


oracle("order_window_stats", """
SELECT customer_id, window_start, window_end, count(*) AS order_count,
       CAST(sum(amount) AS DECIMAL(18,2)) AS total_amount, count(DISTINCT region) AS region_count
FROM fw GROUP BY customer_id, window_start, window_end""", _FRAUD_BASE)

_sc, _rs = _score_sql("order_count", "total_amount", "region_count")
oracle("fraud_alerts", f"""
SELECT 'alert-' || order_id AS alert_id, customer_id, order_id, order_count, total_amount, region_count,
       window_start, window_end, {_sc} AS risk_score, {_rs} AS reason
FROM (SELECT customer_id, order_id, window_start, window_end,
             count(*) OVER w AS order_count,
             CAST(sum(amount) OVER w AS DECIMAL(18,2)) AS total_amount,
             CAST(sum(first_seen) OVER w AS BIGINT) AS region_count
      FROM (SELECT *, CASE WHEN row_number() OVER (PARTITION BY customer_id, window_start, region
                                                 ORDER BY placed_at, order_id) = 1 THEN 1 ELSE 0 END AS first_seen
            FROM fw) f
      WINDOW w AS (PARTITION BY customer_id, window_start ORDER BY placed_at, order_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) r
WHERE {_sc} >= {R.min_score}""", _FRAUD_BASE)

oracle("fraud_alerts_final", f"""
SELECT 'alert-' || customer_id || '-' || strftime(window_start, '%Y%m%d%H%M%S') AS alert_id,
       customer_id, order_count, total_amount, region_count, window_start, window_end,
       {_sc} AS risk_score, {_rs} AS reason
FROM (SELECT customer_id, window_start, window_end, count(*) AS order_count,
             CAST(sum(amount) AS DECIMAL(18,2)) AS total_amount, count(DISTINCT region) AS region_count
      FROM fw GROUP BY customer_id, window_start, window_end) s
WHERE {_sc} >= {R.min_score}""", _FRAUD_BASE)


# --- order life cycle --------------------------------------------------------
_EDGES = ", ".join(f"'{c}>{n}'" for c, nxts in S.VALID_TRANSITIONS.items() for n in nxts)


def _valid(cur: str, req: str) -> str:
    return f"coalesce(({cur} || '>' || {req}) IN ({_EDGES}), false)"


_WALK = {
    "seq": """SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ts, event_id) AS rn FROM state_requests""",
    "walk": f"""
SELECT order_id, rn, '{S.INITIAL_STATUS}' AS state_before,
       CASE WHEN {_valid("'" + S.INITIAL_STATUS + "'", 'requested_status')} THEN requested_status
            ELSE '{S.INITIAL_STATUS}' END AS state_after
FROM seq WHERE rn = 1
UNION ALL
SELECT s.order_id, s.rn, w.state_after,
       CASE WHEN {_valid('w.state_after', 's.requested_status')} THEN s.requested_status ELSE w.state_after END
FROM walk w JOIN seq s ON s.order_id = w.order_id AND s.rn = w.rn + 1""",
    "changes": f"""
SELECT s.order_id, s.customer_id, s.event_id, s.ts, w.state_before AS previous_status,
       s.requested_status AS new_status, {_valid('w.state_before', 's.requested_status')} AS accepted,
       CASE WHEN NOT {_valid('w.state_before', 's.requested_status')}
            THEN 'Invalid: ' || w.state_before || ' -> ' || coalesce(s.requested_status, 'null') END AS reason
FROM seq s JOIN walk w ON s.order_id = w.order_id AND s.rn = w.rn""",
}


def _recursive(sql: str) -> str:
    return with_views(sql, _WALK).replace("WITH ", "WITH RECURSIVE ", 1)


ORACLE["order_state_changes"] = _recursive("SELECT * FROM changes")
ORACLE["state_history"] = _recursive(
    "SELECT order_id, event_id, previous_status AS from_status, new_status AS to_status, ts AS at "
    "FROM changes WHERE accepted")
ORACLE["order_current_state"] = _recursive(f"""
SELECT order_id, coalesce(arg_max(CASE WHEN accepted THEN new_status END,
                                   CASE WHEN accepted THEN (ts, event_id) END), '{S.INITIAL_STATUS}') AS current_status,
       CAST(sum(CASE WHEN accepted THEN 1 ELSE 0 END) AS BIGINT) AS transitions, count(*) AS requests
FROM changes GROUP BY order_id""")
ORACLE["order_state_from_snapshot"] = ORACLE["order_current_state"]
ORACLE["transition_check"] = _recursive(
    f"SELECT order_id, event_id, previous_status, new_status, {_valid('previous_status', 'new_status')} AS valid "
    "FROM changes")


# --- partitioning --------------------------------------------------------------
_MASK = 0xFFFFFFFF


def duck_murmur2(key: str) -> str:
    hx = f"hex({key})"
    n = f"(length({hx}) // 2)"

    def byte(j: str) -> str:
        return f"CAST(('0x' || substr({hx}, 2 * ({j}) + 1, 2)) AS BIGINT)"
    n4 = f"({n} // 4)"
    m = S.MURMUR2_M
    k0 = (f"list_transform(range(0, {n4}), lambda i: {byte('4 * i')} | ({byte('4 * i + 1')} << 8)"
          f" | ({byte('4 * i + 2')} << 16) | ({byte('4 * i + 3')} << 24))")
    k1 = f"list_transform({k0}, lambda k: (k * {m}) & {_MASK})"
    k2 = f"list_transform({k1}, lambda k: (xor(k, k >> {S.MURMUR2_R}) * {m}) & {_MASK})"
    h0 = f"(xor({S.MURMUR2_SEED}, {n}) & {_MASK})"
    body = f"list_reduce(list_prepend({h0}, {k2}), lambda h, k: xor((h * {m}) & {_MASK}, k))"
    t = f"({n4} * 4)"
    rem = f"({n} % 4)"
    tail = (f"xor(xor({body}, CASE WHEN {rem} >= 3 THEN {byte(t + ' + 2')} << 16 ELSE 0 END),"
            f" CASE WHEN {rem} >= 2 THEN {byte(t + ' + 1')} << 8 ELSE 0 END)")
    tail = f"(CASE WHEN {rem} >= 1 THEN (xor({tail}, {byte(t)}) * {m}) & {_MASK} ELSE {tail} END)"
    f1 = f"xor({tail}, {tail} >> 13)"
    f2 = f"(({f1} * {m}) & {_MASK})"
    f3 = f"xor({f2}, {f2} >> 15)"
    return f"CAST(({f3}) & {0x7FFFFFFF} AS BIGINT)"


def _duck_region_partition(key: str, region: str, available: list[int]) -> str:
    h = duck_murmur2(key)
    starts = " ".join(f"WHEN '{r}' THEN {lo}" for r, (lo, hi) in S.REGION_PARTITION_RANGES.items())
    sizes = " ".join(f"WHEN '{r}' THEN {hi - lo + 1}" for r, (lo, hi) in S.REGION_PARTITION_RANGES.items())
    start = f"(CASE {region} {starts} END)"
    size = f"(CASE {region} {sizes} END)"
    avail = "[" + ", ".join(map(str, available)) + "]"
    default = f"{avail}[CAST(({h}) % {len(available)} AS INTEGER) + 1]"
    probes = f"list_transform(range(0, {size}), lambda o: {start} + (({h}) + o) % {size})"
    up = f"list_filter({probes}, lambda p: list_contains({avail}, p))"
    ranged = f"coalesce({up}[1], {default})"
    return f"CAST(CASE WHEN {start} IS NULL THEN {default} ELSE {ranged} END AS INTEGER)"


_ALL = list(range(S.NUM_TOPIC_PARTITIONS))
_OUT = [0, 2, 3, 5, 8, 9, 10, 11]

oracle("murmur2", f"SELECT order_id, customer_id, {duck_murmur2('customer_id')} AS key_hash FROM orders_placed")
oracle("partition_by_region", f"""SELECT order_id, customer_id, region,
       {_duck_region_partition('customer_id', 'region', _ALL)} AS "partition" FROM orders_placed""")
oracle("partition_with_outage", f"""SELECT order_id, customer_id, region,
       {_duck_region_partition('customer_id', 'region', _OUT)} AS "partition" FROM orders_placed""")
oracle("partition_default", f"""SELECT order_id, customer_id,
       CAST([{', '.join(map(str, _OUT))}][CAST(({duck_murmur2('customer_id')}) % {len(_OUT)} AS INTEGER) + 1] AS INTEGER)
       AS "partition" FROM orders_placed""")


def _duck_md5_mod(key: str, n: int) -> str:
    acc = "CAST(0 AS HUGEINT)"
    for i in range(4):
        w = f"CAST(('0x' || substr(md5({key}), {8 * i + 1}, 8)) AS HUGEINT)"
        acc = f"(({acc}) * 4294967296 + {w}) % {n}"
    return f"CAST({acc} AS BIGINT)"


_NONPRI = [p for p in _ALL if p != S.PRIORITY_PARTITION]
oracle("partition_by_priority", f"""SELECT order_id, customer_id, total_amount,
       CAST(CASE WHEN coalesce(total_amount, 0) >= {S.PRIORITY_THRESHOLD} THEN {S.PRIORITY_PARTITION}
            ELSE [{', '.join(map(str, _NONPRI))}][{_duck_md5_mod('customer_id', len(_NONPRI))} + 1] END AS INTEGER)
       AS "partition" FROM orders_placed""")
_ROUTED = {"routed": f"""SELECT order_id, customer_id, region,
       {_duck_region_partition('customer_id', 'region', _ALL)} AS "partition" FROM orders_placed"""}
oracle("partition_skew", 'SELECT "partition", count(*) AS messages FROM routed GROUP BY "partition"', _ROUTED)
oracle("partition_balance", """SELECT count(*) AS partitions, max(messages) AS max_messages, min(messages) AS min_messages,
       round(avg(messages), 6) AS avg_messages, round(max(messages) / avg(messages), 6) AS skew
FROM (SELECT "partition", count(*) AS messages FROM routed GROUP BY "partition") s""", _ROUTED)


from eventide.plans.queries import HEAVY_KEYS, SKETCH_RANGE  # noqa: E402

_HEAVY = {"heavy": f"""SELECT customer_id, count(*) AS orders FROM orders_placed
GROUP BY customer_id HAVING count(*) > (SELECT count(*) FROM orders_placed) // {HEAVY_KEYS + 1}"""}
oracle("heavy_customers", "SELECT customer_id, orders FROM heavy", _HEAVY)
oracle("partition_even", """
SELECT CAST(p AS INTEGER) AS "partition", loads[p + 1] AS messages, n AS messages_by_hash
FROM (SELECT loads FROM placed ORDER BY i DESC LIMIT 1) l, (SELECT p, count(*) AS n FROM hashed GROUP BY p) h""", {
    **_HEAVY,
    "hashed": f"SELECT customer_id, {duck_murmur2('customer_id')} % {len(_ALL)} AS p FROM orders_placed",
    "rest": f"""SELECT list(coalesce(n, 0) ORDER BY r) AS loads FROM range({len(_ALL)}) t(r)
LEFT JOIN (SELECT p, count(*) AS n FROM hashed WHERE customer_id NOT IN (SELECT customer_id FROM heavy) GROUP BY p) ON p = r""",
    "ranked": "SELECT orders, row_number() OVER (ORDER BY orders DESC, customer_id) AS i FROM heavy",
    # heaviest first, each to the partition that is least loaded by then
    "placed": """SELECT CAST(0 AS BIGINT) AS i, loads FROM rest
UNION ALL
SELECT i + 1, list_transform(loads, lambda x, j: CASE WHEN j = least_loaded THEN x + orders ELSE x END)
FROM (SELECT placed.i, loads, orders, list_position(loads, list_min(loads)) AS least_loaded
      FROM placed JOIN ranked ON ranked.i = placed.i + 1) s"""})
ORACLE["partition_even"] = ORACLE["partition_even"].replace("WITH ", "WITH RECURSIVE ", 1)


# --- projections, validation, evolution ------------------------------------------
_K = "CAST(substr(order_id, 7) AS BIGINT)"


def _uuid(seed: str) -> str:
    h = f"md5({seed})"
    return (f"concat_ws('-', substr({h}, 1, 8), substr({h}, 9, 4), substr({h}, 13, 4), "
            f"substr({h}, 17, 4), substr({h}, 21, 12))")


def _txn(oid: str) -> str:
    return f"'txn-' || substr(md5({oid}), 1, 12)"


oracle("order_totals", """
SELECT o.order_id, CAST(coalesce(n, 0) AS INTEGER) AS item_count, CAST(coalesce(q, 0) AS BIGINT) AS item_quantity,
       CAST(coalesce(t, 0) AS DECIMAL(18,2)) AS items_total, o.total_amount
FROM orders_placed o LEFT JOIN (SELECT order_id, count(*) AS n, sum(quantity) AS q, sum(unit_price * quantity) AS t
                                FROM order_items GROUP BY order_id) i ON o.order_id = i.order_id""")
oracle("high_value_flag", f"""SELECT order_id, total_amount,
       coalesce(total_amount, 0) > {S.HIGH_VALUE_THRESHOLD} AS is_high_value FROM orders_placed""")
_GOOD = f"{_K} % 20 <> 0"  # every 20th value of the log is not JSON
_ORDER_COLS = ["order_id", "customer_id", "item_count", "items", "total_amount", "currency", "payment_method", "shipping_address",
               "region", "placed_at"]
oracle("decode_json", f"""
SELECT customer_id AS key, {_GOOD} AS decoded, {", ".join(f"CASE WHEN {_GOOD} THEN {c} END AS {c}" for c in _ORDER_COLS)}
FROM orders_with_items""")
oracle("eos_transform", f"""
SELECT key, source_partition, source_offset, {", ".join(_ORDER_COLS)}, placed_at AS enriched_at, 0 AS processor_instance,
       coalesce(total_amount, 0) > {S.HIGH_VALUE_THRESHOLD} AS is_high_value
FROM (SELECT *, customer_id AS key, p AS source_partition,
             CAST(row_number() OVER (PARTITION BY p ORDER BY placed_at, {_K}) - 1 AS BIGINT) AS source_offset
      FROM (SELECT *, {_duck_region_partition('customer_id', 'region', _ALL)} AS p FROM orders_with_items) x) y
WHERE {_GOOD}""")
def _json_field(col: str, kind: str) -> str:
    """One ``"name":value`` member as Spark's to_json writes it (NULL: left out)."""
    if kind == "str":
        val = f"to_json({col})::VARCHAR"
    elif kind == "ts":  # timestamp_ntz -> yyyy-MM-ddTHH:mm:ss.SSS
        val = f"'\"' || strftime({col}, '%Y-%m-%dT%H:%M:%S.%g') || '\"'"
    elif kind == "json":
        return f"""'"{col}":' || {col}_json"""
    else:  # decimal keeps its scale
        val = f"CAST({col} AS VARCHAR)"
    return f"""CASE WHEN {col} IS NOT NULL THEN '"{col}":' || {val} END"""


_ORDER_JSON = [("order_id", "str"), ("customer_id", "str"), ("items", "json"), ("total_amount", "num"), ("currency", "str"),
               ("payment_method", "str"), ("shipping_address", "str"), ("region", "str"), ("placed_at", "ts")]
oracle("encode_json", f"""
SELECT customer_id AS key,
       '{{' || concat_ws(',', {", ".join(_json_field(c, k) for c, k in _ORDER_JSON)}) || '}}' AS value
FROM orders_with_items""")

oracle("order_wire", """
SELECT order_id, customer_id, CAST(total_amount AS DOUBLE) AS total_amount, currency, payment_method, shipping_address, region,
       epoch_ms(placed_at) AS placed_at, item_count, items
FROM orders_with_items""")
_OK = f"(CAST(('0x' || substr(md5(order_id), 1, 8)) AS BIGINT) % 100 < {S.PAYMENT_SUCCESS_PERCENT})"
oracle("payments", f"""
SELECT {_uuid("'payment:' || order_id")} AS payment_id, order_id, customer_id, total_amount AS amount,
       currency, payment_method,
       CASE WHEN {_OK} THEN 'success' ELSE 'failed' END AS status,
       CASE WHEN NOT {_OK} THEN '{S.PAYMENT_FAILURE_REASON}' END AS failure_reason,
       {_txn('order_id')} AS transaction_ref, placed_at AS processed_at
FROM orders_placed""")
oracle("deterministic_ids", f"""SELECT order_id, {_uuid("'payment:' || order_id")} AS payment_id,
       {_txn('order_id')} AS transaction_ref FROM orders_placed""")
_D = S.ORDER_DEFAULTS
oracle("fill_defaults", f"""
SELECT order_id, coalesce(currency, '{_D['currency']}') AS currency,
       coalesce(payment_method, '{_D['payment_method']}') AS payment_method,
       coalesce(shipping_address, '{_D['shipping_address']}') AS shipping_address,
       coalesce(region, '{_D['region']}') AS region
FROM sparse_orders""")
_METHODS = ", ".join(f"'{m}'" for m in S.PAYMENT_METHODS)
_REGIONS = ", ".join(f"'{r}'" for r in S.REGIONS)
_VIOL = f"""concat_ws(',',
  CASE WHEN NOT coalesce(s.order_id IS NOT NULL, false) THEN 'order_id_required' END,
  CASE WHEN NOT coalesce(customer_id IS NOT NULL, false) THEN 'customer_id_required' END,
  CASE WHEN NOT coalesce(total_amount IS NOT NULL, false) THEN 'total_amount_required' END,
  CASE WHEN NOT coalesce(length(currency) = 3, false) THEN 'currency_length' END,
  CASE WHEN NOT coalesce(payment_method IN ({_METHODS}), false) THEN 'payment_method_enum' END,
  CASE WHEN NOT coalesce(region IN ({_REGIONS}), false) THEN 'region_enum' END,
  CASE WHEN NOT coalesce(qty_ok, true) THEN 'item_quantity_positive' END,
  CASE WHEN NOT coalesce(price_ok, true) THEN 'item_price_positive' END)"""
oracle("validate_orders", f"""
SELECT s.order_id, {_VIOL} = '' AS valid, {_VIOL} AS violations
FROM sparse_orders s LEFT JOIN (SELECT order_id, bool_and(quantity > 0) AS qty_ok, bool_and(unit_price > 0) AS price_ok
                                FROM order_items GROUP BY order_id) i ON s.order_id = i.order_id""")
oracle("constraint_report", """
SELECT 'primary_key(customer_id)' AS "constraint", CAST(coalesce(sum(n), 0) AS BIGINT) AS violations
FROM (SELECT customer_id, count(*) AS n FROM profile_updates GROUP BY customer_id HAVING count(*) > 1) d
UNION ALL SELECT 'not_null(email)', CAST(count(*) FILTER (WHERE email IS NULL) AS BIGINT) FROM profile_updates
UNION ALL SELECT 'not_null(name)', CAST(count(*) FILTER (WHERE name IS NULL) AS BIGINT) FROM profile_updates
UNION ALL SELECT 'max_length(customer_id,50)', CAST(count(*) FILTER (WHERE length(customer_id) > 50) AS BIGINT) FROM profile_updates
UNION ALL SELECT 'max_length(email,255)', CAST(count(*) FILTER (WHERE length(email) > 255) AS BIGINT) FROM profile_updates
UNION ALL SELECT 'max_length(name,255)', CAST(count(*) FILTER (WHERE length(name) > 255) AS BIGINT) FROM profile_updates
UNION ALL SELECT 'max_length(region,20)', CAST(count(*) FILTER (WHERE length(region) > 20) AS BIGINT) FROM profile_updates
UNION ALL SELECT 'max_length(tier,20)', CAST(count(*) FILTER (WHERE length(tier) > 20) AS BIGINT) FROM profile_updates""")
_RET = " ".join(f"WHEN '{t}' THEN {ret}" for t, (_, ret, pol) in S.TOPICS.items() if ret and pol != "compact")
oracle("retention", f"""
SELECT * FROM event_log
WHERE (CASE topic {_RET} END) IS NULL
   OR epoch_ms("timestamp") >= epoch_ms(TIMESTAMP '2024-01-31 00:00:00') - (CASE topic {_RET} END)""")
oracle("archive_layout", """SELECT topic, "partition", "offset",
       strftime("timestamp", 'year=%Y/month=%m/day=%d/hour=%H') AS archive_path FROM event_log""")
_ET = ("CASE WHEN error_name IS NULL THEN NULL WHEN lower(error_name) LIKE '%timeout%' OR lower(error_name) LIKE '%connection%' "
       "OR lower(error_name) LIKE '%unavailable%' THEN 'timeout' "
       "WHEN lower(error_name) LIKE '%decode%' OR lower(error_name) LIKE '%serialize%' "
       "OR lower(error_name) LIKE '%schema%' OR lower(error_name) LIKE '%validation%' THEN 'deserialization_error' "
       "ELSE 'unknown' END")
_PERM = ", ".join(f"'{e}'" for e in S.PERMANENT_ERRORS)
oracle("classify_errors", f"""SELECT event_id, error_name, {_ET} AS error_type,
       coalesce(NOT ({_ET} IN ({_PERM})), false) AS retryable FROM failures""")
oracle("record_headers", """SELECT topic, "partition", "offset", 3 AS header_count,
       'txn-' || topic || '-' || CAST("partition" AS VARCHAR) AS transaction_id,
       CAST("partition" AS VARCHAR) AS source_partition, CAST("offset" AS VARCHAR) AS source_offset FROM event_log""")
oracle("evolve_orders", f"""
SELECT {", ".join(_ORDER_COLS)},
       NULL::VARCHAR AS coupon_code, 'standard' AS priority, '' AS metadata_keys, NULL::VARCHAR AS metadata_priority_code
FROM orders_v1
UNION ALL
SELECT {", ".join(_ORDER_COLS)},
       coupon_code, priority, 'priority_code,source' AS metadata_keys, o_orderpriority AS metadata_priority_code
FROM orders_v2""")
oracle("project_v1", f"""SELECT {", ".join(_ORDER_COLS)} FROM orders_v2""")

# --- joins ---------------------------------------------------------------------------
oracle("enrich_orders_asof", f"""
SELECT o.order_id, o.customer_id,
       coalesce(p.name, '{S.UNKNOWN_CUSTOMER_NAME}') AS customer_name,
       coalesce(p.email, '{S.UNKNOWN_CUSTOMER_EMAIL}') AS customer_email,
       coalesce(p.tier, 'standard') AS customer_tier,
       o.item_count, o.items, o.total_amount, o.currency,
       coalesce(o.total_amount, 0) > {S.HIGH_VALUE_THRESHOLD} AS is_high_value,
       o.region, o.placed_at, o.placed_at AS enriched_at
FROM orders_with_items o ASOF LEFT JOIN profile_updates p
  ON o.customer_id = p.customer_id AND o.placed_at >= p.updated_at""")
oracle("fk_orphans", """SELECT order_id, customer_id FROM orders_placed o
WHERE customer_id IS NOT NULL AND customer_id NOT IN (
  SELECT key FROM (SELECT key, op FROM customer_changes QUALIFY row_number() OVER (PARTITION BY key ORDER BY ts_ms DESC, seq DESC) = 1) c
  WHERE op <> 'd')""")

oracle("fk_orphan_payments", f"""SELECT {_uuid("'payment:' || order_id")} AS payment_id, order_id FROM orders_placed WHERE {_K} % 11 = 0""")
_BAD = f"concat_ws(',', CASE WHEN {_K} % 5 = 0 THEN 'amount_required' END, CASE WHEN {_K} % 7 = 0 THEN 'status_enum' END)"
oracle("validate_payments", f"""SELECT {_uuid("'payment:' || order_id")} AS payment_id, order_id, {_BAD} = '' AS valid, {_BAD} AS violations
FROM orders_placed""")
_ALERTS = ORACLE["fraud_alerts"]
ORACLE["validate_alerts"] = f"""SELECT alert_id, score <= 1.0 AS valid, CASE WHEN score <= 1.0 THEN '' ELSE 'risk_score_range' END AS violations
FROM (SELECT alert_id, CASE WHEN order_count % 2 = 0 THEN 2 ELSE 1 END * risk_score AS score FROM ({_ALERTS}) a) s"""

# --- sources --------------------------------------------------------------------------
oracle("scan_topic", "SELECT * FROM event_log WHERE topic = 'orders.placed'")
oracle("scan_multi_topic", "SELECT * FROM event_log WHERE topic IN ('orders.enriched', 'payments.processed')")
ORACLE["union_topics"] = ORACLE["scan_multi_topic"]
oracle("replay_from_offsets", """
SELECT l.topic, l.key, l.value, l."partition", l."offset", l."timestamp"
FROM event_log l LEFT JOIN (SELECT topic, "partition", floor((max("offset") + 1) / 2) AS from_offset
                            FROM event_log WHERE "partition" < 6 GROUP BY topic, "partition") s
  ON l.topic = s.topic AND l."partition" = s."partition"
WHERE l."offset" >= s.from_offset OR s.from_offset IS NULL""")
oracle("read_first_n", 'SELECT * FROM event_log ORDER BY topic, "partition", "offset" LIMIT 1000')
oracle("assign_batches", f"""SELECT topic, "partition", "offset",
       CAST(floor((row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") - 1) / {S.EOS_BATCH_SIZE}) AS BIGINT)
       AS batch_id FROM event_log""")
oracle("cdc_apply", """
SELECT key AS customer_id, op, ts_ms, name, email, region, tier
FROM (SELECT * FROM customer_changes QUALIFY row_number() OVER (PARTITION BY key ORDER BY ts_ms DESC, seq DESC) = 1) c
WHERE op <> 'd'""")

oracle("cdc_snapshot_customers", """
SELECT key AS customer_id, name, email, region, tier
FROM (SELECT * FROM customer_changes QUALIFY row_number() OVER (PARTITION BY key ORDER BY ts_ms DESC, seq DESC) = 1) c
WHERE op <> 'd'""")
oracle("cdc_snapshot_orders", f"""
SELECT order_id, customer_id, CAST(total_amount + CASE WHEN {_K} % 3 = 0 THEN 10 ELSE 0 END AS DECIMAL(12,2)) AS total_amount, region
FROM orders_placed WHERE {_K} % 11 <> 0""")

# --- monitoring -----------------------------------------------------------------------
from eventide.operators.monitoring import LATENCY_BUCKETS_MS  # noqa: E402

oracle("log_counters", """SELECT topic, "partition", count(*) AS messages, CAST(sum(length(value)) AS BIGINT) AS value_chars
FROM event_log GROUP BY topic, "partition" """)
oracle("error_counters", f"""SELECT topic, {_ET} AS error_type, count(*) AS errors FROM failures
WHERE error_name IS NOT NULL GROUP BY topic, {_ET}""")
_LE = ", ".join(f"CAST(sum(CASE WHEN value <= {b} THEN 1 ELSE 0 END) AS BIGINT) AS le_{b}" for b in LATENCY_BUCKETS_MS)
oracle("latency_histogram", f"""SELECT event_type, {_LE}, count(value) AS count,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS sum_ms FROM events GROUP BY event_type""")
# the sketch's accuracy is over the number of rows of a group here, so that it is exact
oracle("latency_quantiles", """SELECT event_type, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.99) AS p99
FROM events GROUP BY event_type""")
oracle("latency_quantiles_range", f"""
SELECT event_type, count(value) AS "values", quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.9) AS p90, quantile_disc(value, 0.99) AS p99
FROM events WHERE date_trunc('hour', ts) >= TIMESTAMP '{SKETCH_RANGE[0]}' AND date_trunc('hour', ts) < TIMESTAMP '{SKETCH_RANGE[1]}'
GROUP BY event_type""")
oracle("next_offsets", 'SELECT topic, "partition", max("offset") + 1 AS next_offset FROM event_log GROUP BY topic, "partition"')
oracle("consumer_lag", """
SELECT topic, "partition", end_offset, committed_offset, end_offset - committed_offset AS lag,
       CASE WHEN end_offset - committed_offset > 60 THEN 'CRITICAL'
            WHEN end_offset - committed_offset > 30 THEN 'WARNING' ELSE 'OK' END AS severity
FROM (SELECT topic, "partition", max("offset") + 1 AS end_offset,
             CAST(sum(CASE WHEN "timestamp" < TIMESTAMP '2024-01-25 00:00:00' THEN 1 ELSE 0 END) AS BIGINT) AS committed_offset
      FROM event_log GROUP BY topic, "partition") x""")
oracle("rate_alerts", f"""
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, events, errors,
       CAST(CAST(errors AS DECIMAL(20,0)) / events AS DECIMAL(12,6)) AS error_rate,
       CAST(CAST(events AS DECIMAL(20,0)) / 60 AS DECIMAL(12,6)) AS events_per_min,
       CAST(CAST(errors AS DECIMAL(20,0)) / events AS DECIMAL(12,6)) > {S.ERROR_RATE_WARNING} AS error_rate_warning,
       CAST(CAST(events AS DECIMAL(20,0)) / 60 AS DECIMAL(12,6)) > {S.EVENT_RATE_WARNING_PER_MIN} AS event_rate_warning
FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS events,
             CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS errors
      FROM events GROUP BY 1) w""")
oracle("throughput", """
SELECT topic, time_bucket(INTERVAL 1 HOUR, "timestamp") AS window_start, count(*) AS messages,
       CAST(CAST(count(*) AS DECIMAL(20,0)) / 3600 AS DECIMAL(14,6)) AS messages_per_sec
FROM event_log GROUP BY topic, 2""")

# --- reliability ----------------------------------------------------------------------
_CLEAN = "(error_name IS NULL OR fail_times = 0)"
_PERMC = f"({_ET} IN ({_PERM}))"
_OKR = f"({_CLEAN} OR (NOT {_PERMC} AND fail_times < {S.MAX_RETRIES}))"
_ATT = (f"CAST(CASE WHEN {_CLEAN} THEN 1 WHEN {_PERMC} THEN 1 WHEN fail_times < {S.MAX_RETRIES} "
        f"THEN fail_times + 1 ELSE {S.MAX_RETRIES} END AS INTEGER)")
_OUTCOMES = {"outcomes": f"""SELECT * EXCLUDE (attempts), {_OKR} AS ok, {_ATT} AS attempts,
       CASE WHEN NOT {_OKR} THEN {_ET} END AS error_type FROM failures"""}
oracle("process_outcomes", "SELECT event_id, ok, attempts, error_type FROM outcomes", _OUTCOMES)
oracle("process_with_retry", "SELECT event_id, ok, attempts, error_type FROM outcomes", _OUTCOMES)
oracle("retry_schedule", f"""
SELECT event_id, first_failure_at, CAST(r + 1 AS INTEGER) AS attempt,
       CAST({S.RETRY_BACKOFF_MS} * pow(2, r - 1) AS BIGINT) AS backoff_ms,
       first_failure_at + to_milliseconds(CAST({S.RETRY_BACKOFF_MS} * (pow(2, r) - 1) AS BIGINT)) AS retry_at
FROM (SELECT event_id, first_failure_at, unnest(range(1, {S.MAX_RETRIES})) AS r FROM failures WHERE error_name IS NOT NULL) f""")
oracle("dead_letters", f"""
SELECT topic AS original_topic, "partition" AS original_partition, event_id AS original_offset, key AS original_key,
       value AS original_value, error_type || ' after ' || CAST(attempts AS VARCHAR) || ' attempt(s)' AS error_message,
       error_type, attempts AS retry_count, first_failure_at,
       first_failure_at + to_milliseconds(CAST({S.RETRY_BACKOFF_MS} * (pow(2, attempts - 1) - 1) AS BIGINT)) AS last_failure_at
FROM outcomes WHERE NOT ok""", _OUTCOMES)
oracle("redrive_due", f"""
SELECT event_id, {_ET} AS error_type, attempts,
       first_failure_at + to_milliseconds(CAST({S.RETRY_BACKOFF_MS} * (pow(2, attempts) - 1) AS BIGINT)) AS next_retry_at
FROM failures
WHERE error_name IS NOT NULL AND NOT ({_ET} IN ({_PERM})) AND attempts < {S.MAX_RETRIES}
  AND first_failure_at + to_milliseconds(CAST({S.RETRY_BACKOFF_MS} * (pow(2, attempts) - 1) AS BIGINT))
      <= TIMESTAMP '2024-01-15 00:00:00'""")
oracle("dlq_route", f"""
SELECT 'processed' AS sink, key, event_id, NULL AS original_topic, NULL AS failure_reason, NULL AS error_type FROM outcomes WHERE ok
UNION ALL
SELECT '{S.DLQ_TOPIC}', key, event_id, topic, '{S.DLQ_REASON}', error_type FROM outcomes WHERE NOT ok""", _OUTCOMES)
oracle("dlq_summary", """SELECT CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) AS BIGINT) AS processed,
       CAST(sum(CASE WHEN ok THEN 0 ELSE 1 END) AS BIGINT) AS dlq_count FROM outcomes""", _OUTCOMES)


# --- sinks and streaming (results compared with the batch definitions) ------------------
oracle("topic_sink_roundtrip", """SELECT *, 'txn-' || topic || '-' || CAST("partition" AS VARCHAR) AS transaction_id,
       CAST("partition" AS VARCHAR) AS source_partition, CAST("offset" AS VARCHAR) AS source_offset FROM event_log""")
ORACLE["archive_roundtrip"] = ORACLE["scan_topic"].replace(" WHERE topic = 'orders.placed'", "")
oracle("archive_day_range", """SELECT * FROM event_log
WHERE "timestamp" >= TIMESTAMP '2024-01-05 00:00:00' AND "timestamp" < TIMESTAMP '2024-01-13 00:00:00'""")
oracle("codec_roundtrip", """SELECT codec, count(*) AS "rows", CAST(sum(length(value)) AS BIGINT) AS value_chars
FROM event_log, (VALUES ('none'), ('lz4_raw'), ('snappy'), ('zstd')) c(codec) GROUP BY codec""")
ORACLE["dedup_events"] = ORACLE["archive_roundtrip"]
ORACLE["resume_pipeline"] = ORACLE["archive_roundtrip"]
ORACLE["upsert_sink"] = ORACLE["compact_latest"]
oracle("retention_files", f"""
SELECT * FROM event_log
WHERE (CASE topic {_RET} END) IS NULL
   OR epoch_ms(date_trunc('hour', "timestamp")) + 3600000 > epoch_ms(TIMESTAMP '2024-01-31 00:00:00') - (CASE topic {_RET} END)""")
oracle("fan_out", """SELECT 'topic' AS sink, count(*) AS "rows", count(*) AS reported_rows FROM event_log
UNION ALL SELECT 'archive', count(*), count(*) FROM event_log""")
ORACLE["exactly_once_pipeline"] = ORACLE["eos_transform"]
ORACLE["read_committed"] = ORACLE["eos_transform"]
ORACLE["order_window_stats_stream"] = ORACLE["order_window_stats"]
ORACLE["enrich_orders_stream"] = ORACLE["enrich_orders"]
ORACLE["order_state_changes_stream"] = ORACLE["order_state_changes"]
ORACLE["order_state_changes_stream_state"] = ORACLE["order_state_changes"]
ORACLE["fraud_alerts_stream"] = ORACLE["fraud_alerts"]
ORACLE["state_history_stream"] = ORACLE["state_history"]
from eventide.plans.queries import LATE_ORDER_DELAY, LATE_ORDER_JITTER, WEEKS  # noqa: E402

_SLICE = " + ".join(f"CAST(arrival >= TIMESTAMP '{w}' AS INTEGER)" for w in WEEKS)
oracle("fraud_alerts_late", """
SELECT customer_id, order_id, window_start, window_end, placed_at
FROM sliced JOIN marks USING (slice) WHERE epoch_ms(placed_at) <= watermark_ms""", {
    **_FRAUD_BASE,
    "sliced": f"""SELECT *, {_SLICE} AS slice
FROM (SELECT *, placed_at + to_seconds((event_id * 7919) % {LATE_ORDER_JITTER}) AS arrival FROM fw) a""",
    # the watermark of a slice: the newest time of all slices before it, less the delay
    "marks": f"""SELECT s.slice, (SELECT epoch_ms(max(placed_at)) - {LATE_ORDER_DELAY * 1000} FROM sliced b WHERE b.slice < s.slice) AS watermark_ms
FROM (SELECT DISTINCT slice FROM sliced) s"""})
oracle("late_events", """
SELECT order_id, created_at, watermark FROM (
  SELECT order_id, created_at,
         max(created_at) OVER (ORDER BY CAST(substr(order_id, 7) AS BIGINT)
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 30 DAY AS watermark
  FROM shipments) s
WHERE created_at < watermark""")
ORACLE["dedup_events_batch"] = ORACLE["archive_roundtrip"]
ORACLE["fraud_alerts_stream_state"] = ORACLE["fraud_alerts"]
ORACLE["enrich_orders_interleaved"] = ORACLE["enrich_orders_asof"]
ORACLE["enrich_orders_interleaved_state"] = ORACLE["enrich_orders_asof"]
oracle("partition_layout", """SELECT order_id, customer_id, "partition", "partition" AS physical_partition
FROM routed""", _ROUTED)
ORACLE["late_events_stream"] = ORACLE["late_events"]
from eventide.plans.queries import MAX_MESSAGE_BYTES  # noqa: E402
from eventide.streaming.observed import ERROR, SUCCESS, TOO_LARGE  # noqa: E402

_DELIVERED = {"delivered": f"""SELECT *, CASE WHEN coalesce(octet_length(encode(value)), 0) > {MAX_MESSAGE_BYTES} THEN '{TOO_LARGE}' END AS error_type
FROM event_log"""}
oracle("delivery_reports", f"""
SELECT topic, "partition", "offset" AS "position", CASE WHEN error_type IS NULL THEN "offset" END AS "offset",
       CASE WHEN error_type IS NULL THEN '{SUCCESS}' ELSE '{ERROR}' END AS status, error_type
FROM delivered""", _DELIVERED)
oracle("produced_counters_stream", f"""
SELECT 'produced' AS metric, topic, CASE WHEN error_type IS NULL THEN '{SUCCESS}' ELSE '{ERROR}' END AS label, count(*) AS value
FROM delivered GROUP BY ALL
UNION ALL
SELECT 'produce_errors', topic, error_type, count(*) FROM delivered WHERE error_type IS NOT NULL GROUP BY ALL""", _DELIVERED)
oracle("metric_counters", f"""
SELECT 'consumed' AS metric, 'topic=' || topic || ',partition=' || CAST("partition" AS VARCHAR) AS labels, count(*) AS value
FROM event_log GROUP BY topic, "partition"
UNION ALL
SELECT 'errors', 'topic=' || topic || ',error_type=' || {_ET}, count(*) FROM failures WHERE error_name IS NOT NULL
GROUP BY topic, {_ET}
UNION ALL
SELECT 'dlq', 'reason=' || error_type, count(*) FROM outcomes WHERE NOT ok GROUP BY error_type
UNION ALL
SELECT 'retries', 'topic=' || topic, CAST(sum(attempts - 1) AS BIGINT) FROM outcomes GROUP BY topic
UNION ALL
SELECT 'processed', 'status=' || CASE WHEN ok THEN 'ok' ELSE 'dlq' END, count(*) FROM outcomes GROUP BY ok""", _OUTCOMES)
