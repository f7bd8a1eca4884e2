"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory.  Each reads the driver tables (through the
domain views) so its work grows with the data."""

from __future__ import annotations

import contextlib
import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators import joins, tables
from eventide.session import drop_scratch, lean_scratch, scratch_path
from eventide.sources import views as V

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _items_as_text(df: DataFrame) -> DataFrame:
    """The nested ``items`` as a count and one text (product|name|quantity|cents; ...), for plain comparison."""
    line = lambda x: F.concat_ws("|", x["product_id"], x["product_name"], x["quantity"].cast("string"),
                                 F.round(x["unit_price"] * 100).cast("long").cast("string"))
    return df.withColumns({"item_count": F.when(F.col("items").isNotNull(), F.size("items")),
                           "items": F.array_join(F.transform("items", line), ";")})


@query("enrich_orders")
def q_enrich_orders(spark, sf):
    return _items_as_text(joins.enrich_orders(V.orders_with_items(spark, sf), V.customer_profiles(spark, sf)))


@query("compact_latest")
def q_compact_latest(spark, sf):
    return tables.compact_latest(V.profile_updates(spark, sf), ["customer_id"], ["updated_at"])


# --- fraud windows (A-1 .. A-3, W-1) ---------------------------------------
from eventide.operators import windows as W  # noqa: E402


@query("order_window_stats")
def q_order_window_stats(spark, sf):
    return W.order_window_stats(V.fraud_orders(spark, sf), W.SCALED_RULE.window)


@query("fraud_alerts")
def q_fraud_alerts(spark, sf):
    return W.fraud_alerts(V.fraud_orders(spark, sf), W.SCALED_RULE)


@query("fraud_alerts_final")
def q_fraud_alerts_final(spark, sf):
    return W.fraud_alerts_final(V.fraud_orders(spark, sf), W.SCALED_RULE)


# --- order life cycle (T-1, T-2, W-2, J-5) ---------------------------------
from eventide.operators import state_machine as SM  # noqa: E402
from eventide.operators import state_snapshots as SS  # noqa: E402


@query("order_state_changes")
def q_order_state_changes(spark, sf):
    return SM.order_state_changes(V.state_requests(spark, sf))


@query("state_history")
def q_state_history(spark, sf):
    return SM.state_history(SM.order_state_changes(V.state_requests(spark, sf)))


@query("order_current_state")
def q_order_current_state(spark, sf):
    return SM.order_current_state(SM.order_state_changes(V.state_requests(spark, sf)))


SNAPSHOT_CUT = "2024-01-16 00:00:00"


@query("order_state_from_snapshot")
def q_order_state_from_snapshot(spark, sf):
    """T-2: hour functions stored by day, a snapshot of the first half of the month, and the tail since."""
    hours, before = scratch_path(spark, "order-hours"), scratch_path(spark, "order-snapshot")
    SS.write_hours(V.state_requests(spark, sf), hours)
    SS.snapshot(SS.read_hours(spark, hours, until=SNAPSHOT_CUT)).write.parquet(before)
    return SS.current_state(spark.read.parquet(before), SS.read_hours(spark, hours, since=SNAPSHOT_CUT))


@query("transition_check")
def q_transition_check(spark, sf):
    # every request checked against the status its order met (the fold's previous status)
    ch = SM.order_state_changes(V.state_requests(spark, sf))
    return SM.transition_check(ch.select("order_id", "event_id", "previous_status", "new_status"),
                               "previous_status", "new_status")


# --- partitioning (R-1 .. R-6) ----------------------------------------------
from eventide.functions.hashing import murmur2  # noqa: E402
from eventide.operators import partitioning as P  # noqa: E402
from eventide.operators import sketches as SK  # noqa: E402

OUTAGE_AVAILABLE = [0, 2, 3, 5, 8, 9, 10, 11]  # 1 and 4 down, eu-west (6-7) fully down


@query("murmur2")
def q_murmur2(spark, sf):
    o = V.orders_placed(spark, sf)
    return o.select("order_id", "customer_id", murmur2("customer_id").alias("key_hash"))


def _routed(spark, sf):
    o = V.orders_placed(spark, sf)
    return o.select("order_id", "customer_id", "region",
                    P.region_partition("customer_id", "region").alias("partition"))


@query("partition_by_region")
def q_partition_by_region(spark, sf):
    return _routed(spark, sf)


@query("partition_with_outage")
def q_partition_with_outage(spark, sf):
    o = V.orders_placed(spark, sf)
    return o.select("order_id", "customer_id", "region",
                    P.region_partition("customer_id", "region", OUTAGE_AVAILABLE).alias("partition"))


@query("partition_default")
def q_partition_default(spark, sf):
    o = V.orders_placed(spark, sf)
    return o.select("order_id", "customer_id",
                    P.default_partition("customer_id", OUTAGE_AVAILABLE).alias("partition"))


@query("partition_by_priority")
def q_partition_by_priority(spark, sf):
    o = V.orders_placed(spark, sf)
    return o.select("order_id", "customer_id", "total_amount",
                    P.priority_partition("customer_id", "total_amount").alias("partition"))


@query("partition_skew")
def q_partition_skew(spark, sf):
    return P.partition_skew(_routed(spark, sf))


@query("partition_balance")
def q_partition_balance(spark, sf):
    return P.partition_balance(_routed(spark, sf))


HEAVY_KEYS = 1023  # counters of a summary: a heavy customer has more than a 1024th of the orders


@query("heavy_customers")
def q_heavy_customers(spark, sf):
    """R-6: customers with more than a 1024th of all orders, from a Misra-Gries summary, counted exactly."""
    return SK.heavy_keys(V.orders_placed(spark, sf), "customer_id", HEAVY_KEYS).withColumnsRenamed({"key": "customer_id", "rows": "orders"})


@query("partition_even")
def q_partition_even(spark, sf):
    """R-6: partition loads by the key's hash, and after heavy customers are placed heaviest first."""
    orders = V.orders_placed(spark, sf).select("order_id", "customer_id")
    default = P.default_partition("customer_id", list(range(S.NUM_TOPIC_PARTITIONS)))
    even = SK.even_partitions(orders, "customer_id", default, HEAVY_KEYS)
    after = even.groupBy("partition").agg(F.count(F.lit(1)).alias("messages"))
    before = orders.groupBy(default.alias("partition")).agg(F.count(F.lit(1)).alias("messages_by_hash"))
    return after.join(before, "partition", "full")


# --- projections, validation, evolution (P, F, E) -----------------------------
from eventide import schemas as S  # noqa: E402
from eventide.operators import monitoring as M  # noqa: E402
from eventide.operators import reliability as D  # noqa: E402
from eventide.operators import transforms as TR  # noqa: E402
from eventide.operators import change_capture as CC  # noqa: E402
from eventide.sources import topics as TP  # noqa: E402

AS_OF = "2024-01-31 00:00:00"
REDRIVE_AS_OF = "2024-01-15 00:00:00"
COMMITTED_BEFORE = "2024-01-25 00:00:00"
SCALED_LAG_WARNING, SCALED_LAG_CRITICAL = 30, 60  # lag per partition is ~100s of messages here


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


@query("order_totals")
def q_order_totals(spark, sf):
    return TR.order_totals(V.orders_placed(spark, sf), V.order_items(spark, sf))


@query("high_value_flag")
def q_high_value_flag(spark, sf):
    o = V.orders_placed(spark, sf)
    return o.select("order_id", "total_amount", joins.high_value(F.col("total_amount")).alias("is_high_value"))


@query("decode_json")
def q_decode_json(spark, sf):
    return _items_as_text(TP.decode_json(V.orders_log(spark, sf), S.ORDER_PLACED_V1, keep=["key"]).drop("value"))


def _eos(log):
    """Decoded orders with what the exactly-once path adds: the input's key, partition and offset."""
    d = TP.decode_json(log, S.ORDER_PLACED_V1, keep=["key", "partition", "offset"]).filter("decoded").drop("decoded", "value")
    return TR.eos_transform(d.withColumnsRenamed({"partition": "source_partition", "offset": "source_offset"}), processor_instance=0)


@query("eos_transform")
def q_eos_transform(spark, sf):
    return _items_as_text(_eos(V.orders_log(spark, sf)))


@query("order_wire")
def q_order_wire(spark, sf):
    return _items_as_text(TR.order_wire(V.orders_with_items(spark, sf)))


@query("payments")
def q_payments(spark, sf):
    return TR.payments(V.orders_placed(spark, sf).select(
        "order_id", "customer_id", "total_amount", "currency", "placed_at", "payment_method"))


@query("deterministic_ids")
def q_deterministic_ids(spark, sf):
    o = V.orders_placed(spark, sf)
    return o.select("order_id", TR.uuid_from(F.concat(F.lit("payment:"), F.col("order_id"))).alias("payment_id"),
                    TR.transaction_ref(F.col("order_id")).alias("transaction_ref"))


@query("fill_defaults")
def q_fill_defaults(spark, sf):
    f = TR.fill_defaults(V.sparse_orders(spark, sf), S.ORDER_DEFAULTS)
    return f.select("order_id", "currency", "payment_method", "shipping_address", "region")


@query("validate_orders")
def q_validate_orders(spark, sf):
    o = V.sparse_orders(spark, sf).join(TR.item_checks(V.order_items(spark, sf)), "order_id", "left")
    v = TR.validate(o, TR.order_rules())
    return v.select("order_id", "valid", F.concat_ws(",", "violations").alias("violations"))


def _violations(df, rules, *keys):
    v = TR.validate(df, rules)
    return v.select(*keys, "valid", F.concat_ws(",", "violations").alias("violations"))


@query("validate_payments")
def q_validate_payments(spark, sf):
    """F-1: payments by their rules; every seventh order's has a status that is none, every fifth's no amount."""
    k = F.substring_index("order_id", "-", -1).cast("long")
    p = TR.payments(V.orders_placed(spark, sf).select("order_id", "customer_id", "total_amount", "currency", "placed_at", "payment_method"))
    p = p.withColumns({"status": F.when(k % 7 == 0, F.lit("lost")).otherwise(F.col("status")),
                       "amount": F.when(k % 5 != 0, F.col("amount"))})
    return _violations(p, TR.payment_rules(), "payment_id", "order_id")


@query("validate_alerts")
def q_validate_alerts(spark, sf):
    """F-1: alerts by their rules; those of even order counts have their score doubled, which takes some out of range."""
    a = W.fraud_alerts(V.fraud_orders(spark, sf), W.SCALED_RULE)
    a = a.withColumn("risk_score", F.when(F.col("order_count") % 2 == 0, 2 * F.col("risk_score")).otherwise(F.col("risk_score")))
    return _violations(a, TR.alert_rules(), "alert_id")


@query("constraint_report")
def q_constraint_report(spark, sf):
    return TR.constraint_report(V.profile_updates(spark, sf), ["customer_id"], ["email", "name"],
                                {"customer_id": 50, "email": 255, "name": 255, "region": 20, "tier": 20})


@query("retention")
def q_retention(spark, sf):
    return TR.apply_retention(V.event_log(spark, sf), _ts(AS_OF))


@query("archive_layout")
def q_archive_layout(spark, sf):
    a = TR.archive_partition_columns(V.event_log(spark, sf), "timestamp")
    return a.select("topic", "partition", "offset", "archive_path")


@query("classify_errors")
def q_classify_errors(spark, sf):
    return TR.classify_errors(V.failures(spark, sf)).select("event_id", "error_name", "error_type", "retryable")


def _with_source(log):
    return TR.with_headers(log, {
        "transaction_id": F.concat(F.lit("txn-"), F.col("topic"), F.lit("-"), F.col("partition").cast("string")),
        "source_partition": F.col("partition"), "source_offset": F.col("offset")})


@query("record_headers")
def q_record_headers(spark, sf):
    h = _with_source(V.event_log(spark, sf))
    return h.select("topic", "partition", "offset", F.size("headers").alias("header_count"),
                    TR.header_value("transaction_id").alias("transaction_id"),
                    TR.header_value("source_partition").alias("source_partition"),
                    TR.header_value("source_offset").alias("source_offset"))


@query("encode_json")
def q_encode_json(spark, sf):
    return TR.encode_json(V.orders_with_items(spark, sf).select(*S.ORDER_V1_FIELDS), key="customer_id")


@query("evolve_orders")
def q_evolve_orders(spark, sf):
    e = TR.evolve_to_v2(V.orders_v1(spark, sf), V.orders_v2(spark, sf))
    return _items_as_text(e).select(*[c for c in e.columns if c != "metadata"], "item_count",
                    F.concat_ws(",", F.array_sort(F.map_keys("metadata"))).alias("metadata_keys"),
                    F.col("metadata")["priority_code"].alias("metadata_priority_code"))


@query("project_v1")
def q_project_v1(spark, sf):
    return _items_as_text(TR.project_v1(V.orders_v2(spark, sf)))


# --- joins (J-3, J-4) -----------------------------------------------------------
@query("enrich_orders_asof")
def q_enrich_orders_asof(spark, sf):
    return _items_as_text(joins.enrich_orders_asof(V.orders_with_items(spark, sf), V.profile_updates(spark, sf)))


@query("fk_orphans")
def q_fk_orphans(spark, sf):
    """J-4: orders whose customer the change log has deleted."""
    return joins.fk_orphans(V.orders_placed(spark, sf), TP.cdc_apply(V.customer_changes(spark, sf)),
                            "customer_id", "key").select("order_id", "customer_id")


@query("fk_orphan_payments")
def q_fk_orphan_payments(spark, sf):
    """J-4: payments whose order the change log has deleted."""
    orders = V.orders_placed(spark, sf).select("order_id", "customer_id", "total_amount", "currency", "placed_at", "payment_method")
    alive = TP.cdc_apply(V.order_changes(spark, sf), order=["lsn"])
    return joins.fk_orphans(TR.payments(orders), alive, "order_id", "key").select("payment_id", "order_id")


# --- sources (S-1 .. S-6, S-8) ------------------------------------------------------
@query("scan_topic")
def q_scan_topic(spark, sf):
    return TP.scan_topic(V.event_log(spark, sf, topics=["orders.placed"]), "orders.placed")


@query("scan_multi_topic")
def q_scan_multi_topic(spark, sf):
    topics = ["orders.enriched", "payments.processed"]
    return TP.scan_topics(V.event_log(spark, sf, topics=topics), topics)


@query("union_topics")
def q_union_topics(spark, sf):
    """S-2: topics that are stored apart, read as one log."""
    log, base, frames = V.event_log(spark, sf), scratch_path(spark, "stored-topics"), {}
    for topic in ("orders.enriched", "payments.processed"):
        TP.scan_topic(log, topic).drop("topic").write.parquet(f"{base}/{topic}")
        frames[topic] = spark.read.parquet(f"{base}/{topic}")
    return TP.union_topics(frames).select(*S.LOG_FIELDS)


@query("replay_from_offsets")
def q_replay_from_offsets(spark, sf):
    log = V.event_log(spark, sf)
    starts = (M.next_offsets(log).filter(F.col("partition") < 6)
              .select("topic", "partition", F.floor(F.col("next_offset") / 2).alias("from_offset")))
    return TP.replay_from_offsets(log, starts)  # partitions from 6 on: earliest


@query("read_first_n")
def q_read_first_n(spark, sf):
    return TP.read_first_n(V.event_log(spark, sf), 1000)


@query("assign_batches")
def q_assign_batches(spark, sf):
    b = TP.assign_batches(V.event_log(spark, sf), S.EOS_BATCH_SIZE)
    return b.select("topic", "partition", "offset", "batch_id")


@query("cdc_apply")
def q_cdc_apply(spark, sf):
    cur = TP.cdc_apply(V.customer_changes(spark, sf))
    prof = F.from_json("after", "name string, email string, region string, tier string")
    return cur.select(F.col("key").alias("customer_id"), "op", "ts_ms", prof.alias("p")).select(
        "customer_id", "op", "ts_ms", "p.name", "p.email", "p.region", "p.tier")


def _snapshot_of(changes, number, bounds):
    """A chunked read of the table that a change log makes, while it changes: (snapshot, marks).

    Chunk i is read between two marks of the log, each row at a moment of its
    own within; what is read is the row as of that moment.
    """
    spark = changes.sparkSession
    lo, hi = changes.agg(F.min("lsn"), F.max("lsn")).first()
    if lo is None:
        return changes.select("key", "row"), spark.createDataFrame([], "chunk int, low long, high long")
    step = (hi - lo) // (len(bounds) + 2) + 1
    marks = spark.createDataFrame([(i, lo + i * step, lo + (i + 1) * step) for i in range(len(bounds) + 1)], "chunk int, low long, high long")
    moment = F.col("low") + F.pmod(F.xxhash64("key"), F.col("high") - F.col("low") + 1)
    seen = changes.withColumn("chunk", CC.chunk_of(number, bounds)).join(F.broadcast(marks), "chunk").filter(F.col("lsn") <= moment)
    rows = tables.compact_latest(seen.select("key", "lsn", "op", "row"), ["key"], ["lsn"], tombstone=F.col("op") == "d")
    return rows.select("key", "row"), marks


def _captured(log, row_schema):
    """Current rows by a snapshot in four chunks and the change log, whose values are envelopes."""
    changes = CC.parse_envelope(log, row_schema)
    number = F.substring_index("key", "-", -1).cast("long")
    top = log.agg(F.max(number)).first()[0] or 0
    bounds = [top * i // 4 for i in (1, 2, 3)]
    snapshot, marks = _snapshot_of(changes, number, bounds)
    return CC.snapshot_and_changes(snapshot, changes, marks, CC.chunk_of(number, bounds))


@query("cdc_snapshot_customers")
def q_cdc_snapshot_customers(spark, sf):
    """S-8: the customer table by its chunked snapshot joined with the running change log."""
    c = V.customer_changes(spark, sf)
    log = c.select("key", CC.envelope(F.col("op"), F.lit(None).cast("string"), F.col("after"), F.col("ts_ms"), F.col("ts_ms")).alias("value"))
    now = _captured(log, "name string, email string, region string, tier string")
    return now.select(F.col("key").alias("customer_id"), "row.name", "row.email", "row.region", "row.tier")


@query("cdc_snapshot_orders")
def q_cdc_snapshot_orders(spark, sf):
    """S-8: the order table, created, paid more and deleted while it is read."""
    c = V.order_changes(spark, sf)
    log = c.select("key", CC.envelope(*[F.col(x) for x in ("op", "before", "after", "ts_ms", "lsn")]).alias("value"))
    now = _captured(log, "customer_id string, total_amount decimal(12,2), region string")
    return now.select(F.col("key").alias("order_id"), "row.customer_id", "row.total_amount", "row.region")


# --- monitoring (A-5 .. A-10) -----------------------------------------------------
@query("log_counters")
def q_log_counters(spark, sf):
    return M.log_counters(V.event_log(spark, sf))


@query("error_counters")
def q_error_counters(spark, sf):
    f = TR.classify_errors(V.failures(spark, sf)).filter(F.col("error_name").isNotNull())
    return f.groupBy("topic", "error_type").agg(F.count(F.lit(1)).alias("errors"))


@query("latency_histogram")
def q_latency_histogram(spark, sf):
    e = read_events(spark, sf)
    return M.latency_histogram(e, "value", ["event_type"])


@query("latency_quantiles")
def q_latency_quantiles(spark, sf):
    return M.latency_quantiles(read_events(spark, sf), "value", ["event_type"])


SKETCH_RANGE = ("2024-01-05 06:00:00", "2024-01-25 12:00:00")


@query("latency_quantiles_range")
def q_latency_quantiles_range(spark, sf):
    """A-6: quantiles of a range of hours, merged from the stored sketch of each."""
    path = scratch_path(spark, "latency-sketches")
    events = V._events(spark, sf, "ts", "event_type", "value")
    SK.latency_sketches(events, "ts", "value", ["event_type"]).write.partitionBy("day").parquet(path)
    return SK.quantiles_of_range(spark.read.parquet(path), *SKETCH_RANGE, ["event_type"], {"p50": 0.5, "p90": 0.9, "p99": 0.99})


@query("next_offsets")
def q_next_offsets(spark, sf):
    return M.next_offsets(V.event_log(spark, sf))


@query("consumer_lag")
def q_consumer_lag(spark, sf):
    log = V.event_log(spark, sf)
    committed = (log.groupBy("topic", "partition")
                 .agg(F.sum((F.col("timestamp") < _ts(COMMITTED_BEFORE)).cast("long")).alias("committed_offset")))
    return M.consumer_lag(log, committed, SCALED_LAG_WARNING, SCALED_LAG_CRITICAL)


@query("rate_alerts")
def q_rate_alerts(spark, sf):
    e = read_events(spark, sf)
    return M.rate_alerts(e, "ts", F.col("event_type") == "error")


@query("throughput")
def q_throughput(spark, sf):
    return M.throughput(V.event_log(spark, sf))


def read_events(spark, sf):
    from eventide.sources.tables import read_table
    return read_table(spark, sf, "events", "event_id", "ts", "event_type", "value")


# --- reliability (D-1 .. D-5) ---------------------------------------------------------
def fail_by_rule(row):
    """Test process function: raises ``error_name`` on the first ``fail_times``
    attempts at a record, then succeeds."""
    name = row["error_name"]
    if name is not None and row["attempt"] <= row["fail_times"]:
        raise type(name, (Exception,), {})(f"{name} on attempt {row['attempt']}")


@query("process_with_retry")
def q_process_with_retry(spark, sf):
    out = D.process_with_retry(V.failures(spark, sf).drop("attempts"), fail_by_rule)
    return out.select("event_id", "ok", "attempts", "error_type")


def _outcomes(spark, sf):
    return D.process_outcomes(V.failures(spark, sf).drop("attempts"))


@query("process_outcomes")
def q_process_outcomes(spark, sf):
    return _outcomes(spark, sf).select("event_id", "ok", "attempts", "error_type")


@query("retry_schedule")
def q_retry_schedule(spark, sf):
    f = V.failures(spark, sf).filter(F.col("error_name").isNotNull())
    return D.retry_schedule(f.select("event_id", "first_failure_at"), "first_failure_at")


@query("dead_letters")
def q_dead_letters(spark, sf):
    d = D.dead_letters(_outcomes(spark, sf), offset="event_id")
    return d.withColumn("original_value", F.col("original_value").cast("string"))


@query("redrive_due")
def q_redrive_due(spark, sf):
    r = D.redrive_due(V.failures(spark, sf), _ts(REDRIVE_AS_OF))
    return r.select("event_id", "error_type", "attempts", "next_retry_at")


@query("dlq_summary")
def q_dlq_summary(spark, sf):
    return D.dlq_summary(_outcomes(spark, sf))


@query("dlq_route")
def q_dlq_route(spark, sf):
    """D-3: outcomes split over two sinks, dead letters keyed and with headers."""
    base = scratch_path(spark, "dlq-route")
    D.route_outcomes(_outcomes(spark, sf), f"{base}/processed", f"{base}/dlq", offset="event_id")
    ok = spark.read.parquet(f"{base}/processed").select(
        F.lit("processed").alias("sink"), "key", "event_id", F.lit(None).cast("string").alias("original_topic"),
        F.lit(None).cast("string").alias("failure_reason"), F.lit(None).cast("string").alias("error_type"))
    dead = spark.read.parquet(f"{base}/dlq").select(
        "topic", "key", F.col("original_offset"), F.col("headers.original_topic"), F.col("headers.failure_reason"), "error_type")
    return ok.union(dead)


# --- sinks (K-1 .. K-4) -------------------------------------------------------------
from eventide.sinks import files as K  # noqa: E402


@query("topic_sink_roundtrip")
def q_topic_sink_roundtrip(spark, sf):
    """K-1: records written and read back, headers too."""
    path = scratch_path(spark, "topic-sink")
    K.write_topic(_with_source(V.event_log(spark, sf)), path)
    return TP.read_topic_files(spark, path).select(
        *S.LOG_FIELDS, *[TR.header_value(h).alias(h) for h in ("transaction_id", "source_partition", "source_offset")])


UPSERT_CUTS = ["1996-05-10 00:00:00", "1998-10-20 00:00:00"]


@query("upsert_sink")
def q_upsert_sink(spark, sf):
    path = scratch_path(spark, "upsert")
    p = V.profile_updates(spark, sf)
    t = F.col("updated_at")
    batches = [t.isNull() | (t < _ts(UPSERT_CUTS[0])), (t >= _ts(UPSERT_CUTS[0])) & (t < _ts(UPSERT_CUTS[1])), t >= _ts(UPSERT_CUTS[1])]
    for i, cond in enumerate(batches):
        K.upsert(p.filter(cond), path, version=i)
    return K.read_upserted(spark, path, ["customer_id"], ["updated_at"])


ARCHIVE_DAYS = ("2024-01-05", "2024-01-12")


@query("archive_roundtrip")
def q_archive_roundtrip(spark, sf):
    path = scratch_path(spark, "archive")
    K.write_archive(V.event_log(spark, sf), path, "timestamp")
    return K.read_archive(spark, path).select(*S.LOG_FIELDS)


@query("archive_day_range")
def q_archive_day_range(spark, sf):
    """K-3: a bounded read of the archive (whole days, UTC)."""
    path = scratch_path(spark, "archive-days")
    K.write_archive(V.event_log(spark, sf), path, "timestamp")
    return K.read_archive(spark, path, *ARCHIVE_DAYS).select(*S.LOG_FIELDS)


@query("retention_files")
def q_retention_files(spark, sf):
    """F-4 on files: of each topic's archive the hours past its retention are deleted by their folders' names."""
    log, base, kept = V.event_log(spark, sf), scratch_path(spark, "retention"), []
    for topic in sorted(set(V.EVENT_TOPIC.values())):
        _, keep_ms, policy = S.TOPICS[topic]
        K.write_archive(TP.scan_topic(log, topic), f"{base}/{topic}", "timestamp")
        if keep_ms is not None and policy != "compact":
            K.expire_archive(spark, f"{base}/{topic}", dt.datetime.fromisoformat(AS_OF) - dt.timedelta(milliseconds=keep_ms))
        if K.holds_files(spark, f"{base}/{topic}"):
            kept.append(K.read_archive(spark, f"{base}/{topic}").select(*S.LOG_FIELDS))
    return functools.reduce(DataFrame.unionByName, kept)


@query("fan_out")
def q_fan_out(spark, sf):
    base = scratch_path(spark, "fan-out")

    def to_topic(df):
        K.write_topic(df, f"{base}/topic")
        return TP.read_topic_files(spark, f"{base}/topic")

    def to_archive(df):
        K.write_archive(df, f"{base}/archive", "timestamp")
        return K.read_archive(spark, f"{base}/archive")

    counts = K.fan_out(V.event_log(spark, sf), {"topic": to_topic, "archive": to_archive})
    written = [TP.read_topic_files(spark, f"{base}/topic").select(F.lit("topic").alias("sink")),
               K.read_archive(spark, f"{base}/archive").select(F.lit("archive").alias("sink"))]
    got = written[0].unionByName(written[1]).groupBy("sink").agg(F.count(F.lit(1)).alias("rows"))
    return got.withColumn("reported_rows", F.coalesce(
        *[F.when(F.col("sink") == k, F.lit(v)) for k, v in counts.items()]).cast("long"))


# --- streaming (T-3 .. T-7, J-2, T-4, F-5) ---------------------------------------------
from eventide.streaming import keyed_state as KS  # noqa: E402
from eventide.streaming import observed as OB  # noqa: E402
from eventide.streaming import pipelines as ST  # noqa: E402
from eventide.functions.scan import running_sums  # noqa: E402


def _stage(df, spark, name):
    """Write a Spark-derived frame as the file-backed input of a stream."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return path


#: micro-batches of the exactly-once runs, about
EOS_BATCHES = 6
#: orders whose log is made at a time, about: the exchanges of so many are on disk at once
EOS_SLICE = 4_000_000


def _eos_run(spark, sf, runs=2, aborted=False):
    out = scratch_path(spark, "eos-out")
    with lean_scratch(spark):
        first, *more = V.orders_log_slices(spark, sf, EOS_SLICE)
        src = _stage(first, spark, "eos-src")
        for part in more:
            part.write.mode("append").parquet(src)
        drop_scratch(first)
        # a larger log has more files, and takes them in larger micro-batches
        topic = spark.read.schema(S.LOG).parquet(src)
        files = max(2, -(-len(topic.inputFiles()) // EOS_BATCHES))
        for r in range(runs):  # the second run replays every batch (its checkpoint is lost)
            stream = ST.file_stream(spark, src, S.LOG, max_files_per_trigger=files)
            ST.run_exactly_once(_eos(stream), out, scratch_path(spark, f"eos-ckpt{r}"))
        if aborted:  # files of a batch that landed but was never committed
            _eos(spark.read.parquet(src)).write.mode("append").parquet(out)
        drop_scratch(topic)
    return _items_as_text(ST.read_committed(spark, out))


WEEKS = ["2024-01-08 00:00:00", "2024-01-15 00:00:00", "2024-01-22 00:00:00", "2024-01-29 00:00:00"]


def _stream_in_slices(spark, df, ts, name, writer, output_mode="append", cuts=WEEKS, tick=None):
    """Feed ``df`` to a stream slice by slice of ``ts`` (each slice is
    appended to the source folder, then the query catches up): bounded
    micro-batches in arrival order, like a live topic.  Cuts are timestamps
    (strings) or numbers."""
    src, ckpt = scratch_path(spark, f"{name}-src"), scratch_path(spark, f"{name}-ckpt")
    made = scratch_path(spark, f"{name}-made")

    def lit(c):
        return _ts(c) if isinstance(c, str) else F.lit(c)
    # rows without a time come first; the frame is made once, whatever the number of slices
    number = functools.reduce(lambda a, b: a + b, [F.when(F.col(ts) >= lit(c), 1).otherwise(0) for c in cuts])
    df.withColumn("__slice", number).write.partitionBy("__slice").parquet(made)
    sliced = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("__slice", T.IntegerType())])).parquet(made)
    for i in range(len(cuts) + 1):
        sliced.filter(F.col("__slice") == i).drop("__slice").write.mode("append").parquet(src)
        yield ST.file_stream(spark, src, df.schema), ckpt
    if tick is not None:
        tick.write.mode("append").parquet(src)
        yield ST.file_stream(spark, src, df.schema), ckpt


YEARS = [f"{y}-01-01 00:00:00" for y in range(1997, 2002, 2)]
#: seconds by which rows arrive late at most, in the queries of rows out of order
DAY = 86400


def _out_of_order(df, at, number, seconds):
    """``df`` with the time a row arrives: up to ``seconds`` after its own, by its number."""
    late_by = F.make_dt_interval(secs=F.pmod(F.col(number) * 7919, F.lit(seconds)))
    return df.withColumn("__arrival", F.col(at) + late_by)


def _tick(df, at):
    """One row of nulls with a time far ahead: a source's heartbeat, which moves the watermark past all rows before it."""
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    return df.sparkSession.range(1).select(*nulls).withColumn(at, _ts("2100-01-01 00:00:00"))


@contextlib.contextmanager
def _state_partitions(spark):
    """Twice the cores, if the session asks for more shuffle partitions: each one is a state store of its own."""
    most, key = 2 * spark.sparkContext.defaultParallelism, "spark.sql.shuffle.partitions"
    before = spark.conf.get(key, "200")
    spark.conf.set(key, str(min(int(before), most)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _run_slices(spark, df, arrival, at, name, build, cuts):
    """Feed ``df`` in slices of ``arrival`` and then a tick to the stream that ``build`` makes; (its output, its checkpoint)."""
    out, ckpt = scratch_path(spark, f"{name}-out"), None
    for stream, ckpt in _stream_in_slices(spark, df, arrival, name, None, cuts=cuts, tick=_tick(df, at)):
        with _state_partitions(spark):
            ST.run_until_caught_up(build(stream), ST.append_batches(out), ckpt)
    return ST.read_batches(spark, out).drop("batch_id"), ckpt


def _enrichment_events(spark, sf):
    """Orders and profile updates as one stream of both kinds, and the orders' schema."""
    orders = V.orders_with_items(spark, sf)
    number = lambda c: F.substring_index(c, "-", -1).cast("long")
    events = orders.select(
        F.lit("order").alias("kind"), "customer_id", F.col("placed_at").alias("at"), KS.order_payload(orders).alias("payload"),
        number("order_id").alias("number")).unionByName(V.profile_updates(spark, sf).select(
            F.lit("profile").alias("kind"), "customer_id", F.col("updated_at").alias("at"), "name", "email", "tier",
            number("customer_id").alias("number")), allowMissingColumns=True)
    return events, orders.schema


def _enriched_by_stream(spark, sf, name, delay, shuffled):
    events, schema = _enrichment_events(spark, sf)
    if shuffled:
        events = _out_of_order(events, "at", "number", delay)
    got, _ = _run_slices(spark, events, "__arrival" if shuffled else "at", "at", name,
                         lambda s: KS.asof_enrichment_stream(s, schema, delay), YEARS)
    return _items_as_text(got.filter("kind = 'order' and not late").drop("kind", "late"))


@query("enrich_orders_interleaved_state")
def q_enrich_orders_interleaved_state(spark, sf):
    """J-2: orders and profile updates on one stream, in event-time slices."""
    return _enriched_by_stream(spark, sf, "j2s", DAY, False)


@query("enrich_orders_interleaved")
def q_enrich_orders_interleaved(spark, sf):
    """J-2/J-3: orders and profile updates on one stream, out of order by up to 90 days."""
    return _enriched_by_stream(spark, sf, "j2", 90 * DAY, True)


@query("exactly_once_pipeline")
def q_exactly_once_pipeline(spark, sf):
    return _eos_run(spark, sf, runs=2)


@query("read_committed")
def q_read_committed(spark, sf):
    return _eos_run(spark, sf, runs=1, aborted=True)


@query("order_window_stats_stream")
def q_order_window_stats_stream(spark, sf):
    out = scratch_path(spark, "win-out")
    for stream, ckpt in _stream_in_slices(spark, V.fraud_orders(spark, sf), "placed_at", "win", None):
        stats = ST.window_stats_stream(stream, W.SCALED_RULE.window)
        ST.run_until_caught_up(stats, ST.append_batches(out), ckpt, "update")
    # update mode re-emits a window whenever it changes: keep its last version
    got = ST.read_batches(spark, out)
    return tables.compact_latest(got, ["customer_id", "window_start"], ["batch_id"]).drop("batch_id")


def _with_resends(log):
    """The log plus re-sent copies of every 10th message (producer retries)."""
    return log.unionByName(log.filter(F.pmod(F.col("offset"), F.lit(10)) == 0))


@query("dedup_events")
def q_dedup_events(spark, sf):
    out = scratch_path(spark, "dedup-out")
    for stream, ckpt in _stream_in_slices(spark, _with_resends(V.event_log(spark, sf)), "timestamp", "dedup", None):
        d = ST.dedup_stream(stream, ["topic", "partition", "offset"])
        ST.run_until_caught_up(d, ST.append_batches(out), ckpt)
    return ST.read_batches(spark, out).drop("batch_id")


RESUME_CUT = "2024-01-16 00:00:00"


@query("resume_pipeline")
def q_resume_pipeline(spark, sf):
    log = V.event_log(spark, sf)
    src, out, ckpt = scratch_path(spark, "resume-src"), scratch_path(spark, "resume-out"), scratch_path(spark, "resume-ckpt")
    log.filter(F.col("timestamp").isNull() | (F.col("timestamp") < _ts(RESUME_CUT))).write.mode("append").parquet(src)
    ST.run_until_caught_up(ST.file_stream(spark, src, S.LOG), ST.append_batches(out), ckpt)
    # new data arrives; the restarted query resumes from its checkpoint
    log.filter(F.col("timestamp") >= _ts(RESUME_CUT)).write.mode("append").parquet(src)
    ST.run_until_caught_up(ST.file_stream(spark, src, S.LOG), ST.append_batches(out), ckpt)
    return ST.read_batches(spark, out).drop("batch_id")


@query("enrich_orders_stream")
def q_enrich_orders_stream(spark, sf):
    """J-2 as a stream-table join: each micro-batch of orders meets the profile table as it is then."""
    profiles, orders = V.profile_updates(spark, sf), V.orders_with_items(spark, sf)
    table, out = scratch_path(spark, "prof-table"), scratch_path(spark, "enrich-out")
    # profiles arrive first here
    ST.run_until_caught_up(ST.file_stream(spark, _stage(profiles, spark, "prof-src"), profiles.schema),
                           lambda batch, n: K.upsert(batch, table, n), scratch_path(spark, "prof-ckpt"))

    def enrich(batch, batch_id):
        now = K.read_upserted(spark, table, ["customer_id"], ["updated_at"])
        joins.enrich_orders(batch, now).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    ST.run_until_caught_up(ST.file_stream(spark, _stage(orders, spark, "ord-src"), orders.schema), enrich,
                           scratch_path(spark, "enrich-ckpt"))
    return _items_as_text(ST.read_batches(spark, out).drop("batch_id"))


@query("order_state_changes_stream")
def q_order_state_changes_stream(spark, sf):
    """T-1 streaming, the whole log in one micro-batch: the longest run of requests an order can have."""
    reqs, out = V.state_requests(spark, sf), scratch_path(spark, "sm-out")
    stream = ST.file_stream(spark, _stage(reqs, spark, "sm-src"), reqs.schema)
    with _state_partitions(spark):
        ST.run_until_caught_up(KS.order_state_stream(stream), ST.append_batches(out), scratch_path(spark, "sm-ckpt"))
    return ST.read_batches(spark, out).drop("batch_id")


def _state_run(spark, sf, name):
    return _run_slices(spark, V.state_requests(spark, sf), "ts", "ts", name, KS.order_state_stream, WEEKS)


@query("order_state_changes_stream_state")
def q_order_state_changes_stream_state(spark, sf):
    """T-1 streaming in weekly slices: the status an order has at the end of one is what the next starts from."""
    return _state_run(spark, sf, "sms")[0].filter("order_id is not null")


@query("state_history_stream")
def q_state_history_stream(spark, sf):
    """W-2 read from the state of the running stream: the list of accepted transitions that every order has there."""
    return KS.order_history(spark, _state_run(spark, sf, "smh")[1])


def _alerts(spark, sf, name, delay, shuffled):
    orders = V.fraud_orders(spark, sf)
    if shuffled:
        orders = _out_of_order(orders, "placed_at", "event_id", delay)
    got, _ = _run_slices(spark, orders, "__arrival" if shuffled else "placed_at", "placed_at", name,
                         lambda s: KS.running_windows_stream(s, 5 * DAY, delay), WEEKS)
    return W.alert_rows(got.filter("not late"), W.SCALED_RULE)


@query("fraud_alerts_stream")
def q_fraud_alerts_stream(spark, sf):
    """A-2 streaming, orders out of order by up to three days."""
    return _alerts(spark, sf, "fab", 3 * DAY, True)


@query("fraud_alerts_stream_state")
def q_fraud_alerts_stream_state(spark, sf):
    """A-2 streaming, orders in event-time slices."""
    return _alerts(spark, sf, "fa", DAY, False)


LATE_ORDER_DELAY, LATE_ORDER_JITTER = 2 * DAY, 20 * DAY


@query("fraud_alerts_late")
def q_fraud_alerts_late(spark, sf):
    """A-2 streaming, orders out of order by far more than the delay: the side output of those that came too late."""
    orders = _out_of_order(V.fraud_orders(spark, sf), "placed_at", "event_id", LATE_ORDER_JITTER)
    got, _ = _run_slices(spark, orders, "__arrival", "placed_at", "fal",
                         lambda s: KS.running_windows_stream(s, 5 * DAY, LATE_ORDER_DELAY), WEEKS)
    return got.filter("late").select("customer_id", "order_id", "window_start", "window_end", "placed_at")


LATE_DELAY_DAYS = 30


@query("late_events")
def q_late_events(spark, sf):
    """T-7: shipments arrive in order-key order; one is late when its event
    time is more than the delay behind the newest event time seen before it
    (a global running max - the whole log is one key, split by the scan)."""
    sh = V.shipments(spark, sf).select("order_id", F.substring_index("order_id", "-", -1).cast("long").alias("arrival"),
                                       "created_at")
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("created_at"))
    run = running_sums(sh.withColumn("__all", F.lit(0)), ["__all"], ["arrival"], {"__max_us": us},
                       inclusive=False, agg="max", every_key=True)
    wm = F.timestamp_add("MICROSECOND", F.col("__max_us"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    late = run.withColumn("watermark", F.timestamp_add("DAY", F.lit(-LATE_DELAY_DAYS), wm))
    return late.filter(F.col("created_at") < F.col("watermark")).select("order_id", "created_at", "watermark")


@query("dedup_events_batch")
def q_dedup_events_batch(spark, sf):
    return ST.dedup_batch(_with_resends(V.event_log(spark, sf)))


@query("codec_sizes")
def q_codec_sizes(spark, sf):
    return K.codec_sizes(V.event_log(spark, sf), scratch_path(spark, "codecs"))


@query("codec_roundtrip")
def q_codec_roundtrip(spark, sf):
    return K.codec_roundtrip(V.event_log(spark, sf), scratch_path(spark, "codec-roundtrip"))


@query("partition_layout")
def q_partition_layout(spark, sf):
    """R-1 + R-7: rows placed in the Spark partition their routing names."""
    routed = _routed(spark, sf)
    laid = P.layout_by_partition(routed, F.col("partition"), S.NUM_TOPIC_PARTITIONS)
    return laid.select("order_id", "customer_id", "partition",
                       F.spark_partition_id().alias("physical_partition"))


@query("late_events_stream")
def q_late_events_stream(spark, sf):
    """T-7 streaming: shipments arrive in order-key order in slices; late ones
    go to the dead-letter folder, which is returned."""
    sh = V.shipments(spark, sf).select(
        "order_id", F.substring_index("order_id", "-", -1).cast("long").alias("arrival"), "created_at")
    n_max = V.shipments(spark, sf).agg(F.max(F.substring_index("order_id", "-", -1).cast("long"))).first()[0] or 0
    cuts = [int(n_max * i / 5) for i in range(1, 5)]  # five arrival slices
    out, dlq, state = scratch_path(spark, "late-out"), scratch_path(spark, "late-dlq"), scratch_path(spark, "late-state")
    writer = ST.late_router_writer(state, out, dlq, "created_at", "arrival", LATE_DELAY_DAYS)
    for stream, ckpt in _stream_in_slices(spark, sh, "arrival", "late", writer, cuts=cuts):
        ST.run_until_caught_up(stream, writer, ckpt)
    return ST.read_batches(spark, dlq).select("order_id", "created_at", "watermark")


MAX_MESSAGE_BYTES = 8  # of the test events' values some have 9: so that some are refused


@query("delivery_reports")
def q_delivery_reports(spark, sf):
    """X-6: what a producer is told of each record."""
    d = OB.delivery_reports(V.event_log(spark, sf).withColumn("position", F.col("offset")), MAX_MESSAGE_BYTES)
    return d.select("topic", "partition", "position", "offset", "status", "error_type")


@query("produced_counters_stream")
def q_produced_counters_stream(spark, sf):
    """A-5: produced{topic,status} and produce_errors{topic,error_type}, observed while a stream writes its records."""
    src = _stage(V.event_log(spark, sf), spark, "produce-src")
    stream = OB.delivery_reports(ST.file_stream(spark, src, S.LOG, max_files_per_trigger=4), MAX_MESSAGE_BYTES)
    log = OB.run_observed(stream, "produced", OB.produced_counters(), scratch_path(spark, "produce-out"), scratch_path(spark, "produce-ck"))
    return OB.counter_table(spark, log.totals("produced"))


@query("metric_counters")
def q_metric_counters(spark, sf):
    """A-5: labelled counters in long form (metric, labels, value):
    consumed{topic,partition}, errors{topic,error_type}, dlq{reason},
    retries{topic}, processed{status}."""
    log = V.event_log(spark, sf)
    out = D.process_outcomes(V.failures(spark, sf).drop("attempts"))
    consumed = log.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("consumed").alias("metric"),
        F.concat(F.lit("topic="), "topic", F.lit(",partition="), F.col("partition").cast("string")).alias("labels"),
        "value")
    errors = out.filter(F.col("error_name").isNotNull()).withColumn("et", TR.classify_error(F.col("error_name"))) \
        .groupBy("topic", "et").agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("errors").alias("metric"), F.concat(F.lit("topic="), "topic", F.lit(",error_type="), "et").alias("labels"),
        "value")
    dlq = out.filter(~F.col("ok")).groupBy("error_type").agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("dlq").alias("metric"), F.concat(F.lit("reason="), "error_type").alias("labels"), "value")
    retries = out.groupBy("topic").agg(F.sum(F.col("attempts") - 1).cast("long").alias("value")).select(
        F.lit("retries").alias("metric"), F.concat(F.lit("topic="), "topic").alias("labels"), "value")
    processed = out.groupBy("ok").agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("processed").alias("metric"),
        F.concat(F.lit("status="), F.when(F.col("ok"), F.lit("ok")).otherwise(F.lit("dlq"))).alias("labels"), "value")
    return consumed.unionByName(errors).unionByName(dlq).unionByName(retries).unionByName(processed)
