"""P-1 .. P-15, F-1, F-2, F-4, E-1, E-2: projections, validation, evolution.

All per-row Column expressions (narrow, inside whole-stage codegen);
``constraint_report`` uses partial-aggregating group-bys only.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide import schemas as S
from eventide.functions.columns import ntz_to_millis, to_money
from eventide.functions.schema_resolution import declare, read_as
from eventide.operators.joins import high_value


# P-1 ---------------------------------------------------------------------------
def line_total(item: Column) -> Column:
    return item["unit_price"] * item["quantity"]


def order_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Item count, quantity and sum of unit_price * quantity per order.

    Items are flat rows (one per order line); the per-order sums are a
    partial-aggregating group-by, so an order with very many lines is
    combined on the mappers (no per-order array is built)."""
    per = items.groupBy("order_id").agg(
        F.count(F.lit(1)).cast("int").alias("item_count"),
        F.sum(F.col("quantity").cast("long")).alias("item_quantity"),
        F.sum(F.col("unit_price") * F.col("quantity")).cast(S.MONEY_SUM).alias("items_total"))
    j = orders.select("order_id", "total_amount").join(per, "order_id", "left")
    return j.select("order_id", F.coalesce("item_count", F.lit(0)).alias("item_count"),
                    F.coalesce("item_quantity", F.lit(0).cast("long")).alias("item_quantity"),
                    F.coalesce("items_total", F.lit(0).cast(S.MONEY_SUM)).alias("items_total"),
                    "total_amount")


def nested_order_total(items: str = "items") -> Column:
    """P-1 on a nested order record (an ``items`` array already in the row)."""
    zero = F.lit(0).cast(S.MONEY_SUM)
    return F.aggregate(items, zero, lambda acc, x: (acc + line_total(x)).cast(S.MONEY_SUM))


def item_checks(items: DataFrame) -> DataFrame:
    """Per-order item rules over flat item rows (partial-aggregating):
    every quantity > 0 and every unit price > 0."""
    return items.groupBy("order_id").agg(
        F.bool_and(F.coalesce(F.col("quantity") > 0, F.lit(False))).alias("items_quantity_ok"),
        F.bool_and(F.coalesce(F.col("unit_price") > 0, F.lit(False))).alias("items_price_ok"))


# P-3 ---------------------------------------------------------------------------
def eos_transform(decoded: DataFrame, processor_instance: int = 0,
                  enriched_at: Column | None = None, amount: str = "total_amount") -> DataFrame:
    """Pass every field through; add ``enriched_at``, ``processor_instance``
    and ``is_high_value`` (missing or non-numeric amount counts as 0)."""
    stamp = enriched_at if enriched_at is not None else F.col("placed_at")
    return decoded.withColumns({
        "enriched_at": stamp,
        "processor_instance": F.lit(processor_instance),
        "is_high_value": high_value(to_money(F.col(amount))),
    })


# P-5 ---------------------------------------------------------------------------
def order_wire(orders: DataFrame) -> DataFrame:
    """Wire form: decimals -> double, timestamps -> epoch ms; a nested
    ``items`` array (when present) gets double unit prices.  Other columns
    pass through."""
    out = orders.withColumns({
        "total_amount": F.col("total_amount").cast("double"),
        "placed_at": ntz_to_millis(F.col("placed_at")),
    })
    if "items" in orders.columns:
        out = out.withColumn("items", F.transform("items", lambda x: F.struct(
            x["product_id"].alias("product_id"), x["product_name"].alias("product_name"),
            x["quantity"].alias("quantity"), x["unit_price"].cast("double").alias("unit_price"))))
    return out


# P-6 / P-10 ----------------------------------------------------------------------
def uuid_from(seed: Column) -> Column:
    """Deterministic UUID-shaped id from md5 (replays give the same id)."""
    h = F.md5(seed)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def transaction_ref(order_id: Column) -> Column:
    return F.concat(F.lit("txn-"), F.substring(F.md5(order_id), 1, 12))


def default_success(order_id: Column) -> Column:
    """Deterministic stand-in for the 95 % random outcome."""
    h = F.conv(F.substring(F.md5(order_id), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(100)) < F.lit(S.PAYMENT_SUCCESS_PERCENT)


def payments(enriched: DataFrame, success: Column | None = None,
             processed_at: Column | None = None) -> DataFrame:
    """PaymentProcessed from decoded enriched orders with the record defaults."""
    oid = F.coalesce(F.col("order_id"), F.lit("unknown"))
    ok = success if success is not None else default_success(oid)
    return enriched.select(
        uuid_from(F.concat(F.lit("payment:"), oid)).alias("payment_id"),
        oid.alias("order_id"),
        F.coalesce(F.col("customer_id"), F.lit("unknown")).alias("customer_id"),
        F.coalesce(to_money(F.col("total_amount")), F.lit(0).cast(S.MONEY)).alias("amount"),
        F.coalesce(F.col("currency"), F.lit(S.ORDER_DEFAULTS["currency"])).alias("currency"),
        F.coalesce(F.col("payment_method"), F.lit(S.ORDER_DEFAULTS["payment_method"])).alias("payment_method"),
        F.when(ok, F.lit("success")).otherwise(F.lit("failed")).alias("status"),
        F.when(~ok, F.lit(S.PAYMENT_FAILURE_REASON)).alias("failure_reason"),
        transaction_ref(oid).alias("transaction_ref"),
        (processed_at if processed_at is not None else F.col("placed_at")).alias("processed_at"),
    )


# P-7 ---------------------------------------------------------------------------
def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Replace nulls / absent columns with the schema defaults."""
    out = df
    for c, v in defaults.items():
        if c in out.columns:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v).cast(out.schema[c].dataType)))
        else:
            out = out.withColumn(c, F.lit(v))
    return out


# P-8 ---------------------------------------------------------------------------
def with_headers(df: DataFrame, headers: dict[str, Column]) -> DataFrame:
    """Kafka-sink headers column ``array<struct<key string, value binary>>``."""
    arr = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").cast("binary").alias("value"))
                    for k, v in headers.items()])
    return df.withColumn("headers", arr)


def header_value(name: str, headers: str = "headers") -> Column:
    """Read one header back as a string."""
    hit = F.filter(headers, lambda h: h["key"] == F.lit(name))
    return F.try_element_at(hit, F.lit(1))["value"].cast("string")


# P-9 ---------------------------------------------------------------------------
def encode_json(df: DataFrame, key: str | None = None) -> DataFrame:
    cols = [c for c in df.columns]
    out = [F.to_json(F.struct(*cols)).alias("value")]
    if key:
        out.insert(0, F.col(key).alias("key"))
    return df.select(*out)


# P-13 / P-14 -------------------------------------------------------------------
def classify_error(error_name: Column) -> Column:
    """Lower-cased error type name -> timeout / deserialization_error / unknown; no error, no class."""
    low = F.lower(error_name)
    expr = None
    for subs, label in S.ERROR_NAME_CLASSES:
        cond = None
        for s in subs:
            c = low.contains(s)
            cond = c if cond is None else (cond | c)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.when(error_name.isNotNull(), expr.otherwise(F.lit(S.ERROR_CLASS_DEFAULT)))


def classify_names(names: pd.Series) -> pd.Series:
    """The same classes for a column of error names inside a Python task."""
    low, out = names.str.lower(), pd.Series(S.ERROR_CLASS_DEFAULT, index=names.index, dtype=object)
    for subs, label in reversed(S.ERROR_NAME_CLASSES):
        out[low.str.contains("|".join(subs), na=False)] = label
    return out.where(names.notna(), None)


def is_retryable(error_type: Column) -> Column:
    """Permanent classes are never retried, nor is what did not fail; everything else (unknown too) is."""
    return F.coalesce(~error_type.isin(*S.PERMANENT_ERRORS), F.lit(False))


def classify_errors(df: DataFrame, error_name: str = "error_name") -> DataFrame:
    et = classify_error(F.col(error_name))
    return df.withColumn("error_type", et).withColumn("retryable", is_retryable(F.col("error_type")))


# P-15 --------------------------------------------------------------------------
def archive_partition_columns(df: DataFrame, ts: str) -> DataFrame:
    """year / month / day / hour (UTC wall time) and the path they form."""
    t = F.col(ts)
    out = df.withColumns({
        "year": F.date_format(t, "yyyy"), "month": F.date_format(t, "MM"),
        "day": F.date_format(t, "dd"), "hour": F.date_format(t, "HH")})
    return out.withColumn("archive_path", F.concat(
        F.lit("year="), F.col("year"), F.lit("/month="), F.col("month"),
        F.lit("/day="), F.col("day"), F.lit("/hour="), F.col("hour")))


# F-1 ---------------------------------------------------------------------------
def order_rules() -> dict[str, Column]:
    """Field constraints of an order row (name -> Column that must hold).

    Item rules read ``items_quantity_ok`` / ``items_price_ok`` from
    ``item_checks`` when present (flat items), else the nested ``items``."""
    return {
        "order_id_required": F.col("order_id").isNotNull(),
        "customer_id_required": F.col("customer_id").isNotNull(),
        "total_amount_required": F.col("total_amount").isNotNull(),
        "currency_length": F.length("currency") == 3,
        "payment_method_enum": F.col("payment_method").isin(*S.PAYMENT_METHODS),
        "region_enum": F.col("region").isin(*S.REGIONS),
        "item_quantity_positive": F.coalesce(F.col("items_quantity_ok"), F.lit(True)),
        "item_price_positive": F.coalesce(F.col("items_price_ok"), F.lit(True)),
    }


def nested_item_rules(items: str = "items") -> dict[str, Column]:
    """Item rules for rows carrying a nested ``items`` array."""
    arr = F.coalesce(F.col(items), F.array())
    return {"item_quantity_positive": F.forall(arr, lambda x: x["quantity"] > 0),
            "item_price_positive": F.forall(arr, lambda x: x["unit_price"] > 0)}


def payment_rules() -> dict[str, Column]:
    """Field constraints of a payment row."""
    return {
        "payment_id_required": F.col("payment_id").isNotNull(),
        "order_id_required": F.col("order_id").isNotNull(),
        "amount_required": F.col("amount").isNotNull(),
        "currency_length": F.length("currency") == 3,
        "payment_method_enum": F.col("payment_method").isin(*S.PAYMENT_METHODS),
        "status_enum": F.col("status").isin(*S.PAYMENT_STATUSES),
    }


def alert_rules() -> dict[str, Column]:
    """Field constraints of a fraud alert."""
    return {
        "alert_id_required": F.col("alert_id").isNotNull(),
        "customer_id_required": F.col("customer_id").isNotNull(),
        "risk_score_range": F.col("risk_score").between(0.0, 1.0),
        "window_order": F.col("window_start") < F.col("window_end"),
    }


def validate(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add ``violations`` (names of failed rules, in rule order) and ``valid``.
    A rule that evaluates to null counts as failed."""
    checks = [F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]
    out = df.withColumn("violations", F.array_compact(F.array(*checks)))
    return out.withColumn("valid", F.size("violations") == 0)


# F-2 ---------------------------------------------------------------------------
def constraint_report(df: DataFrame, pk: list[str], not_null: list[str],
                      max_length: dict[str, int]) -> DataFrame:
    """One row per constraint with the number of violating rows."""
    dup = (df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") > 1)
             .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("violations"))
             .select(F.lit("primary_key(" + ",".join(pk) + ")").alias("constraint"), "violations"))
    checks = {f"not_null({c})": F.col(c).isNull() for c in not_null}
    checks.update({f"max_length({c},{n})": F.length(c) > n for c, n in max_length.items()})
    row = df.agg(*[F.sum(cond.cast("long")).cast("long").alias(name) for name, cond in checks.items()])
    stack = "stack({n}, {pairs}) as (constraint, violations)".format(
        n=len(checks), pairs=", ".join(f"'{k}', `{k}`" for k in checks))
    per_col = row.selectExpr(stack).select("constraint", F.coalesce("violations", F.lit(0)).cast("long").alias("violations"))
    return dup.unionByName(per_col)


# F-4 ---------------------------------------------------------------------------
def apply_retention(log: DataFrame, as_of: Column, topics: dict | None = None) -> DataFrame:
    """Keep rows younger than their topic's retention at ``as_of``;
    compacted topics and unknown topics have no time limit."""
    topics = topics or S.TOPICS
    kv = []
    for t, (_, ret, policy) in topics.items():
        if ret is not None and policy != "compact":
            kv += [F.lit(t), F.lit(ret).cast("long")]
    ret_ms = F.try_element_at(F.create_map(*kv), F.col("topic"))
    cutoff_ms = ntz_to_millis(as_of) - ret_ms
    return log.filter(ret_ms.isNull() | (ntz_to_millis(F.col("timestamp")) >= cutoff_ms))


# E-1 / E-2 ----------------------------------------------------------------------
def _order_schema(df: DataFrame, version: T.StructType) -> str:
    """The declared schema of a version, of the columns that ``df`` has of it."""
    have = T.StructType([T.StructField(f.name, df.schema[f.name].dataType) for f in version.fields if f.name in df.columns])
    return declare(have, "order")


def evolve_to_v2(v1: DataFrame, v2: DataFrame) -> DataFrame:
    """Read v1 and v2 rows as one v2 table: each by its writer's schema, missing fields by the reader's defaults."""
    old = [f for f in S.ORDER_PLACED_V1.fields if f.name in v1.columns]
    new = [f for f in S.ORDER_PLACED_V2.fields if f.name in S.ORDER_V2_DEFAULTS]
    fields = [T.StructField(f.name, v1.schema[f.name].dataType) for f in old] + new
    reader = declare(T.StructType(fields), "order", S.ORDER_V2_DEFAULTS)
    read = [read_as(df, _order_schema(df, version), reader) for df, version in ((v1, S.ORDER_PLACED_V1), (v2, S.ORDER_PLACED_V2))]
    return read[0].unionByName(read[1])


def project_v1(df: DataFrame) -> DataFrame:
    """Read any later version as v1: the writer's further fields are passed over."""
    return read_as(df, _order_schema(df, S.ORDER_PLACED_V2), _order_schema(df, S.ORDER_PLACED_V1))
