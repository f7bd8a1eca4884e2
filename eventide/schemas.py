"""Record schemas, enumerations and the fixed values of the order domain.

Everything here is data: StructTypes for each record kind, the enum members,
the order life-cycle edges, the region partition ranges, topic settings and
the schema defaults.  Operators read these values; none of them is a
hidden wall-clock or a magic number inside an operator.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results).
# ---------------------------------------------------------------------------

# Order life-cycle states, in declaration order.
ORDER_STATUSES = ["placed", "paid", "payment_failed", "fulfilled", "shipped", "delivered", "cancelled"]

# Valid transitions: current status -> allowed next statuses.
VALID_TRANSITIONS = {
    "placed": ["paid", "payment_failed", "cancelled"],
    "paid": ["fulfilled", "cancelled"],
    "payment_failed": ["placed", "cancelled"],
    "fulfilled": ["shipped"],
    "shipped": ["delivered"],
    "delivered": [],
    "cancelled": [],
}
INITIAL_STATUS = "placed"

PAYMENT_METHODS = ["credit_card", "debit_card", "paypal", "bank_transfer", "crypto"]
PAYMENT_STATUSES = ["success", "failed", "pending", "refunded"]
REGIONS = ["us-east", "us-west", "eu-west", "eu-central", "apac"]

# Region -> inclusive partition range on a 12-partition topic.
REGION_PARTITION_RANGES = {
    "us-east": (0, 2),
    "us-west": (3, 5),
    "eu-west": (6, 7),
    "eu-central": (8, 9),
    "apac": (10, 11),
}
NUM_TOPIC_PARTITIONS = 12

# Kafka-compatible murmur2 constants.
MURMUR2_SEED = 0x9747B28C
MURMUR2_M = 0x5BD1E995
MURMUR2_R = 24

# Priority partitioner.
PRIORITY_PARTITION = 0
PRIORITY_THRESHOLD = 1000.0

# High-value order threshold (strictly greater than).
HIGH_VALUE_THRESHOLD = 500.0

# Fraud rule defaults: 5 minute tumbling window, state expiry 30 minutes.
FRAUD_WINDOW = "5 minutes"
FRAUD_EXPIRY = "30 minutes"
FRAUD_MAX_ORDERS = 10
FRAUD_MAX_AMOUNT = 5000.0
FRAUD_MAX_REGIONS = 3
FRAUD_WEIGHT_FREQ = 0.4
FRAUD_WEIGHT_SPEND = 0.3
FRAUD_WEIGHT_REGIONS = 0.3
FRAUD_ALERT_MIN_SCORE = 0.4

# Dead-letter handling.
MAX_RETRIES = 3
RETRY_BACKOFF_MS = 1000
PERMANENT_ERRORS = ["deserialization_error", "schema_mismatch", "validation_error"]
# Substrings of the lower-cased error type name -> error class.
ERROR_NAME_CLASSES = [
    (["timeout", "connection", "unavailable"], "timeout"),
    (["decode", "serialize", "schema", "validation"], "deserialization_error"),
]
ERROR_CLASS_DEFAULT = "unknown"
DLQ_TOPIC = "orders.dlq"
DLQ_REASON = "max_retries_exceeded"

# Micro-batch sizes.
EOS_BATCH_SIZE = 50

# Payments.
PAYMENT_FAILURE_REASON = "insufficient_funds"
PAYMENT_SUCCESS_PERCENT = 95

# Enrichment miss defaults.
UNKNOWN_CUSTOMER_NAME = "Unknown"
UNKNOWN_CUSTOMER_EMAIL = "unknown@example.com"

# Monitoring thresholds.
LAG_WARNING = 10_000
LAG_CRITICAL = 100_000
ERROR_RATE_WARNING = 0.01
EVENT_RATE_WARNING_PER_MIN = 1.0

# Archive sink.
ARCHIVE_FLUSH_RECORDS = 1000
ARCHIVE_CODEC = "snappy"

# Topics: name -> (partitions, retention ms or None, cleanup policy).
TOPICS = {
    "orders.placed": (12, 604_800_000, "delete"),
    "orders.enriched": (12, 604_800_000, "delete"),
    "orders.fraud_alerts": (3, 2_592_000_000, "delete"),
    "orders.state_changes": (12, 2_592_000_000, "delete"),
    "orders.dlq": (1, 7_776_000_000, "delete"),
    "payments.processed": (6, 604_800_000, "delete"),
    "shipments.created": (6, 604_800_000, "delete"),
    "customers.profiles": (6, None, "compact"),
}

# Schema defaults (applied to absent / null fields).
ORDER_DEFAULTS = {
    "currency": "USD",
    "payment_method": "credit_card",
    "shipping_address": "",
    "region": "us-east",
}
CUSTOMER_DEFAULTS = {
    "email": "",
    "name": "",
    "region": "us-east",
    "tier": "standard",
    "lifetime_orders": 0,
}
ORDER_V2_DEFAULTS = {"coupon_code": None, "priority": "standard", "metadata": {}}

# ---------------------------------------------------------------------------
# StructTypes
# ---------------------------------------------------------------------------

MONEY = T.DecimalType(12, 2)
MONEY_SUM = T.DecimalType(18, 2)

ORDER_ITEM = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", MONEY),
])

CUSTOMER = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("tier", T.StringType()),
    T.StructField("lifetime_orders", T.IntegerType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

ORDER_PLACED_V1 = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("items", T.ArrayType(ORDER_ITEM)),
    T.StructField("total_amount", MONEY),
    T.StructField("currency", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("shipping_address", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("placed_at", T.TimestampNTZType()),
])
ORDER_V1_FIELDS = [f.name for f in ORDER_PLACED_V1.fields]

ORDER_PLACED_V2 = T.StructType(ORDER_PLACED_V1.fields + [
    T.StructField("coupon_code", T.StringType()),
    T.StructField("priority", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])
ORDER_V2_FIELDS = [f.name for f in ORDER_PLACED_V2.fields]

PAYMENT_PROCESSED = T.StructType([
    T.StructField("payment_id", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("amount", MONEY),
    T.StructField("currency", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("failure_reason", T.StringType()),
    T.StructField("transaction_ref", T.StringType()),
    T.StructField("processed_at", T.TimestampNTZType()),
])

FRAUD_ALERT = T.StructType([
    T.StructField("alert_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("order_count", T.LongType()),
    T.StructField("total_amount", MONEY_SUM),
    T.StructField("window_start", T.TimestampNTZType()),
    T.StructField("window_end", T.TimestampNTZType()),
    T.StructField("risk_score", T.DoubleType()),
    T.StructField("reason", T.StringType()),
])

# The fixed columns of a topic log (file-backed twin of a Kafka source).
LOG = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])
LOG_FIELDS = [f.name for f in LOG.fields]
