"""Domain views derived from the driver tables.

Each view is a DataFrame built from the Parquet tables, so its work grows
with the data.  The identical definitions in DuckDB SQL live in
``eventide.plans.oracle``.  Money columns are built from integer cents so
both engines produce the exact same DECIMAL values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide import schemas as S
from eventide.functions.columns import money_from_cents, ntz_to_millis, pick
from eventide.functions.scan import row_positions
from eventide.session import drop_scratch, scratch_path
from eventide.sources.tables import read_table

# Fixed values of the test mapping.
TIERS = ["standard", "premium", "enterprise"]
SEGMENT_TIER = {"BUILDING": 1, "MACHINERY": 2}  # index into TIERS; others 0
EVENT_TOPIC = {
    "purchase": "orders.placed",
    "view": "orders.enriched",
    "click": "payments.processed",
    "signup": "customers.profiles",
    "error": "orders.dlq",
}
ERROR_NAMES = ["TimeoutError", "ConnectionError", "JSONDecodeError", "UnicodeDecodeError",
               "ValidationError", "SchemaError", "RuntimeError", None]
PROFILE_VERSIONS = 3
PROFILE_EPOCH = "1994-06-01 00:00:00"
#: rows of a topic partition that one task numbers when they carry whole orders as JSON (about a kilobyte each)
WIDE_CHUNK_ROWS = 250_000
#: a log with more rows in a partition gets its offsets before the orders meet their items
PLAIN_LOG_ROWS = 25_000
CARRIERS = ["ups", "fedex", "dhl", "usps"]
_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"]


def orders_placed(spark: SparkSession, sf_dir: str, *raw: str) -> DataFrame:
    """Order records; ``raw`` columns of the table come along from the same scan."""
    return _placed(read_table(spark, sf_dir, "orders", *_ORDER_COLUMNS, *raw), *raw)


def _placed(o: DataFrame, *raw: str) -> DataFrame:
    k = F.col("o_orderkey")
    return o.select(
        F.concat(F.lit("order-"), k.cast("string")).alias("order_id"),
        F.concat(F.lit("cust-"), F.col("o_custkey").cast("string")).alias("customer_id"),
        money_from_cents(F.floor("o_totalprice")).alias("total_amount"),
        F.lit("USD").alias("currency"),
        pick(S.PAYMENT_METHODS, F.pmod(F.floor(k / 5), F.lit(5))).alias("payment_method"),
        F.concat(k.cast("string"), F.lit(" Market St")).alias("shipping_address"),
        pick(S.REGIONS, F.pmod(k, F.lit(5))).alias("region"),
        F.col("o_orderdate").alias("placed_at"),
        *raw,
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_lines(spark, sf_dir).select(
        F.concat(F.lit("order-"), F.col("l_orderkey").cast("string")).alias("order_id"),
        "line_number", _product_id(F.col("l_partkey")).alias("product_id"), "product_name", "quantity", "unit_price")


def _product_id(partkey: Column) -> Column:
    return F.concat(F.lit("PROD-"), partkey.cast("string"))


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines under the keys of the tables."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_linenumber",
                    "l_quantity", "l_extendedprice")
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name")
    # part grows with the data: let AQE pick the join from runtime sizes.
    j = li.join(part, li.l_partkey == part.p_partkey, "left")
    return j.select(
        "l_orderkey", F.col("l_linenumber").alias("line_number"), "l_partkey", F.col("p_name").alias("product_name"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money_from_cents(F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity"))).alias("unit_price"),
    )


def orders_with_items(spark: SparkSession, sf_dir: str, *raw: str) -> DataFrame:
    """Order records with their nested ``items`` (an order's own lines, by line
    number); an order without lines has none."""
    item = F.struct("line_number", "product_id", "product_name", "quantity", "unit_price")
    items = order_items(spark, sf_dir).groupBy("order_id").agg(F.sort_array(F.collect_list(item)).alias("items"))
    j = orders_placed(spark, sf_dir, *raw).join(items, "order_id", "left")
    return j.withColumn("items", _bare(F.col("items"), items.schema["items"].dataType))


def _bare(items: Column, kind: T.DataType) -> Column:
    """Sorted items without their line numbers; none where there are no lines."""
    bare = F.transform(F.coalesce(items, F.array().cast(kind)), lambda x: x.dropFields("line_number"))
    return bare.cast("array<struct<product_id:string,product_name:string,quantity:int,unit_price:decimal(12,2)>>")


def profile_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned customer profile rows (3 per customer)."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    o = read_table(spark, sf_dir, "orders", "o_custkey")
    counts = o.groupBy("o_custkey").agg(F.count(F.lit(1)).cast("int").alias("lifetime_orders"))
    # nation is a fixed 25-row dimension: broadcasting it is bounded.
    j = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")
    j = j.join(counts, j.c_custkey == counts.o_custkey, "left")
    j = j.withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(PROFILE_VERSIONS - 1))))
    key = F.col("c_custkey")
    base_tier = F.coalesce(*[F.when(F.col("c_mktsegment") == seg, F.lit(i))
                             for seg, i in SEGMENT_TIER.items()], F.lit(0))
    days = F.col("v") * 800 + F.pmod(key * 7, F.lit(700))
    return j.select(
        F.concat(F.lit("cust-"), key.cast("string")).alias("customer_id"),
        F.concat(F.lit("customer"), key.cast("string"),
                 F.when(F.col("v") == 0, F.lit("")).otherwise(F.concat(F.lit(".v"), F.col("v").cast("string"))),
                 F.lit("@example.com")).alias("email"),
        F.col("c_name").alias("name"),
        pick(S.REGIONS, F.col("n_regionkey")).alias("region"),
        pick(TIERS, F.pmod(base_tier + F.col("v"), F.lit(3))).alias("tier"),
        F.coalesce(F.col("lifetime_orders"), F.lit(0)).alias("lifetime_orders"),
        (F.lit(PROFILE_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(days.cast("int"))).alias("updated_at"),
    )


def customer_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest profile per customer (the compacted profile table)."""
    from eventide.operators.tables import compact_latest
    return compact_latest(profile_updates(spark, sf_dir), ["customer_id"], ["updated_at"])


def _events(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    return read_table(spark, sf_dir, "events", *cols)


def event_topic(event_type: Column) -> Column:
    return F.coalesce(*[F.when(event_type == t, F.lit(topic)) for t, topic in EVENT_TOPIC.items()],
                      F.lit("orders.placed"))


def event_log(spark: SparkSession, sf_dir: str, topics: list[str] | None = None) -> DataFrame:
    """File-backed topic log: one row per event, offsets assigned per
    (topic, partition) in event order; every 20th value is not JSON.

    With ``topics`` only those topics are built: offsets depend only on a
    topic's own rows, so the choice is pushed to the Parquet scan as an
    ``event_type IN (...)`` filter before any offset work."""
    e = _events(spark, sf_dir, "event_id", "ts", "user_id", "event_type", "props")
    if topics is not None:
        types = [t for t, topic in EVENT_TOPIC.items() if topic in topics]
        keep = F.col("event_type").isin(*types) if types else F.lit(False)
        if "orders.placed" in topics:  # the fallback topic of unknown types
            keep = keep | ~F.col("event_type").isin(*EVENT_TOPIC.keys()) | F.col("event_type").isNull()
        e = e.filter(keep)
    rows = e.select(
        event_topic(F.col("event_type")).alias("topic"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("key"),
        F.when(F.pmod(F.col("event_id"), F.lit(20)) == 0, F.lit("not-json"))
         .otherwise(F.col("props")).alias("value"),
        F.pmod(F.col("user_id"), F.lit(S.NUM_TOPIC_PARTITIONS)).cast("int").alias("partition"),
        F.col("event_id"),
        F.col("ts").alias("timestamp"),
    )
    pos = row_positions(rows, ["topic", "partition"], ["event_id"], name="offset")
    return pos.select(*S.LOG_FIELDS)


def fraud_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir, "event_id", "ts", "user_id", "value")
    return e.select(
        F.concat(F.lit("evt-"), F.col("event_id").cast("string")).alias("order_id"),
        F.col("event_id"),
        F.concat(F.lit("cust-"), F.col("user_id").cast("string")).alias("customer_id"),
        pick(S.REGIONS, F.pmod(F.col("event_id"), F.lit(5))).alias("region"),
        money_from_cents(F.round(F.col("value") * 100)).alias("amount"),
        F.col("ts").alias("placed_at"),
    )


def state_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir, "event_id", "ts", "user_id")
    return e.select(
        F.concat(F.lit("order-"), F.col("user_id").cast("string")).alias("order_id"),
        F.concat(F.lit("cust-"), F.col("user_id").cast("string")).alias("customer_id"),
        F.col("event_id"),
        pick(S.ORDER_STATUSES, F.pmod(F.col("event_id"), F.lit(7))).alias("requested_status"),
        F.col("ts"),
    )


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processing outcomes of log records: the error a record raises, how many
    times in a row it fails, and attempts already made (retry table)."""
    e = _events(spark, sf_dir, "event_id", "ts", "user_id", "event_type", "props")
    err = pick(ERROR_NAMES, F.pmod(F.col("event_id"), F.lit(8)))
    return e.select(
        F.col("event_id"),
        event_topic(F.col("event_type")).alias("topic"),
        F.pmod(F.col("user_id"), F.lit(S.NUM_TOPIC_PARTITIONS)).cast("int").alias("partition"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("key"),
        F.col("props").alias("value"),
        err.alias("error_name"),
        F.when(err.isNull(), F.lit(0)).otherwise(F.pmod(F.col("event_id"), F.lit(5))).cast("int").alias("fail_times"),
        (F.pmod(F.col("event_id"), F.lit(3)) + 1).cast("int").alias("attempts"),
        F.col("ts").alias("first_failure_at"),
    )


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity", "l_shipdate")
    per = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).cast("int").alias("items_count"),
                                      F.max("l_shipdate").alias("created_at"),
                                      F.sum("l_quantity").alias("qty"))
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    j = per.join(o, per.l_orderkey == o.o_orderkey, "inner")
    k = F.col("l_orderkey")
    return j.select(
        F.concat(F.lit("ship-"), k.cast("string")).alias("shipment_id"),
        F.concat(F.lit("order-"), k.cast("string")).alias("order_id"),
        F.concat(F.lit("cust-"), F.col("o_custkey").cast("string")).alias("customer_id"),
        pick(CARRIERS, F.pmod(k, F.lit(4))).alias("carrier"),
        F.concat(F.lit("TRK"), k.cast("string")).alias("tracking_number"),
        (F.col("created_at") + F.make_dt_interval(F.lit(5))).alias("estimated_delivery"),
        F.col("items_count"),
        (F.col("qty") * 0.5).alias("weight_kg"),
        F.col("created_at"),
    )


def orders_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v1 order rows: the even order keys."""
    o = orders_with_items(spark, sf_dir)
    return o.filter(F.pmod(F.substring_index("order_id", "-", -1).cast("long"), F.lit(2)) == 0)


def orders_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v2 order rows: the odd order keys, with coupon, priority and metadata."""
    base = orders_with_items(spark, sf_dir, "o_orderpriority")
    k = F.substring_index("order_id", "-", -1).cast("long")
    return base.filter(F.pmod(k, F.lit(2)) == 1).select(
        *[c for c in base.columns if c != "o_orderpriority"],
        F.when(F.pmod(k, F.lit(3)) == 0, F.concat(F.lit("SAVE"), F.pmod(k, F.lit(50)).cast("string")))
         .alias("coupon_code"),
        F.when(F.col("o_orderpriority").startswith("1"), F.lit("high"))
         .otherwise(F.lit("standard")).alias("priority"),
        F.create_map(F.lit("source"), F.lit("web"), F.lit("priority_code"),
                     F.col("o_orderpriority")).alias("metadata"),
    )


def orders_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``orders.placed`` topic: orders as JSON keyed by customer, routed
    by the region partitioner; every 20th order key is a corrupt value."""
    return orders_log_slices(spark, sf_dir, None)[0]


def orders_log_slices(spark: SparkSession, sf_dir: str, slice_rows: int | None) -> list[DataFrame]:
    """The rows of ``orders_log`` in frames of about ``slice_rows`` orders, by the hash of the order's key.

    Written one after the other they need the exchanges of one slice on disk at a time.
    """
    from eventide.operators.partitioning import region_partition
    slot, k = region_partition("customer_id", "region").alias("partition"), F.substring_index("order_id", "-", -1).cast("long")
    most, rows = orders_placed(spark, sf_dir).groupBy(slot).count().agg(F.max("count"), F.sum("count")).first()
    if (most or 0) <= PLAIN_LOG_ROWS:
        wide = _messages(orders_with_items(spark, sf_dir), k, slot, k.alias("__k"))
        pos = row_positions(wide, ["topic", "partition"], ["timestamp", "__k"], name="offset", max_chunk_rows=WIDE_CHUNK_ROWS)
        return [pos.select(*S.LOG_FIELDS)]
    numbered, lines = _numbered_orders(spark, sf_dir, slot, k), _order_lines(spark, sf_dir).filter("l_orderkey is not null")
    slices = max(1, -(-rows // slice_rows)) if slice_rows else 1

    def of(df: DataFrame, key: str, i: int) -> DataFrame:
        return df.filter(F.pmod(F.xxhash64(key), F.lit(slices)) == i) if slices > 1 else df
    return [_messages(_with_lines(of(numbered, "o_orderkey", i), of(lines, "l_orderkey", i)), k, "partition", "offset").select(*S.LOG_FIELDS)
            for i in range(slices)]


def _messages(o: DataFrame, k: Column, *more: Column | str) -> DataFrame:
    """Orders as messages of the log."""
    return o.select(
        F.lit("orders.placed").alias("topic"),
        F.col("customer_id").alias("key"),
        F.when(F.pmod(k, F.lit(20)) == 0, F.lit("not-json"))
         .otherwise(F.to_json(F.struct(*S.ORDER_V1_FIELDS))).alias("value"),
        F.col("placed_at").alias("timestamp"), *more)


def _numbered_orders(spark: SparkSession, sf_dir: str, slot: Column, k: Column) -> DataFrame:
    """Orders with partition and offset, for a large log: a written table of the order table's own columns.

    Offsets are given before orders meet their items and become texts, so no exchange carries the JSON.
    """
    routed = orders_placed(spark, sf_dir, "o_orderkey", "o_custkey", "o_totalprice").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.col("placed_at").alias("o_orderdate"), slot, k.alias("__k"))
    routed = _written(spark, routed, "routed")  # an order without key has drawn its slot here
    numbered = row_positions(routed, ["partition"], ["o_orderdate", "__k"], name="offset", max_chunk_rows=WIDE_CHUNK_ROWS)
    table = _written(spark, numbered.drop("__k"), "numbered")
    drop_scratch(numbered)
    return table


def _written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _with_lines(numbered: DataFrame, lines: DataFrame) -> DataFrame:
    """Numbered orders as order records with their nested ``items``."""
    line = F.struct("line_number", "l_partkey", "product_name", "quantity", "unit_price")
    # lines go to their order's task as they are: gathered before, each would go as a list of its own
    lists = lines.repartition("l_orderkey").groupBy("l_orderkey").agg(F.collect_list(line).alias("lines"))
    item = lambda x: F.struct(x["line_number"].alias("line_number"), _product_id(x["l_partkey"]).alias("product_id"),
                              x["product_name"].alias("product_name"), x["quantity"].alias("quantity"), x["unit_price"].alias("unit_price"))
    j = numbered.join(lists, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("items", F.sort_array(F.transform("lines", item)))
    return _placed(j.withColumn("items", _bare(F.col("items"), j.schema["items"].dataType)), "items", "partition", "offset")


def sparse_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with fields left out (nulls) and a few invalid values, to
    exercise default filling and validation."""
    o = orders_placed(spark, sf_dir)
    k = F.substring_index("order_id", "-", -1).cast("long")
    return o.select(
        "order_id", "customer_id", "total_amount",
        F.when(F.pmod(k, F.lit(3)) == 0, F.lit(None).cast("string")).otherwise(F.col("currency")).alias("currency"),
        F.when(F.pmod(k, F.lit(4)) == 0, F.lit(None).cast("string")).otherwise(F.col("payment_method")).alias("payment_method"),
        F.when(F.pmod(k, F.lit(7)) == 0, F.lit(None).cast("string")).otherwise(F.col("shipping_address")).alias("shipping_address"),
        F.when(F.pmod(k, F.lit(11)) == 0, F.lit("mars"))
         .when(F.pmod(k, F.lit(13)) == 0, F.lit(None).cast("string")).otherwise(F.col("region")).alias("region"),
        "placed_at")


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CDC change rows (Debezium-like) for the customer table: create for the
    first version, update after, delete for every 7th customer's late versions."""
    p = profile_updates(spark, sf_dir)
    num = F.substring_index("customer_id", "-", -1).cast("long")
    op = (F.when(F.col("updated_at") < F.lit("1996-06-01 00:00:00").cast("timestamp_ntz"), F.lit("c"))
          .when((F.pmod(num, F.lit(7)) == 0) & (F.col("updated_at") >= F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")),
                F.lit("d"))
          .otherwise(F.lit("u")))
    after = F.to_json(F.struct("name", "email", "region", "tier"))
    return p.select(op.alias("op"), F.col("customer_id").alias("key"),
                    F.when(op != "d", after).alias("after"),
                    F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                                     F.col("updated_at")).alias("ts_ms"),
                    F.lit(0).alias("seq"))


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of the order table: (key, lsn, op, before, after, ts_ms), one log position per change.

    Every order is created; every third is paid more a day later, every eleventh
    deleted two days later.
    """
    o = orders_placed(spark, sf_dir)
    k = F.substring_index("order_id", "-", -1).cast("long")
    row = lambda amount: F.to_json(F.struct("customer_id", amount.alias("total_amount"), "region"))
    created, paid = row(F.col("total_amount")), row((F.col("total_amount") + 10).cast(S.MONEY))
    third, eleventh = F.pmod(k, F.lit(3)) == 0, F.pmod(k, F.lit(11)) == 0
    none = F.lit(None).cast("string")
    step = lambda op, n, when, before, after: F.when(when, F.struct(
        F.lit(op).alias("op"), F.lit(n).alias("n"), before.alias("before"), after.alias("after")))
    steps = F.array_compact(F.array(step("c", 0, F.lit(True), none, created), step("u", 1, third, created, paid),
                                    step("d", 2, eleventh, F.when(third, paid).otherwise(created), none)))
    each = o.select("order_id", k.alias("k"), "placed_at", F.explode(steps).alias("s"))
    ts_ms = ntz_to_millis(F.col("placed_at")) + F.col("s.n") * 86_400_000
    return each.select(F.col("order_id").alias("key"), "s.op", "s.before", "s.after", ts_ms.alias("ts_ms"),
                       # a position that all changes have one of, in their order: by time, then order, then step
                       (ts_ms / 86_400_000 * 4_000_000_000 + F.col("k") * 4 + F.col("s.n")).cast("long").alias("lsn"))
