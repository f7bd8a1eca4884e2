"""S-1 .. S-6, S-8: topic logs as DataFrames.

A topic is a DataFrame with the fixed log schema (``schemas.LOG``).  The
file-backed twin stores it as Parquet partitioned by ``topic`` so a
single-topic scan prunes to one folder; a real cluster can read Kafka with
``read_kafka`` (needs the Kafka package on the classpath) and gets the same
columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide import schemas as S
from eventide.functions.columns import instant_to_ntz
from eventide.functions.scan import row_positions


def read_topic_files(spark: SparkSession, path: str, topics: list[str] | None = None) -> DataFrame:
    """Scan a file-backed log (Parquet partitioned by topic); records that were written with headers have them."""
    df = spark.read.parquet(path)
    if topics:
        df = df.filter(F.col("topic").isin(*topics))  # partition pruning
    return df.select(*S.LOG_FIELDS, *[c for c in df.columns if c == "headers"])


def read_kafka(spark: SparkSession, servers: str, topics: list[str], starting: str = "earliest",
               ending: str | None = None, stream: bool = False, read_committed: bool = True,
               max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Kafka source with the log columns (S-1, S-2, S-3, F-5).  For streams,
    ``max_offsets_per_trigger`` bounds each micro-batch (S-4/S-5), which
    bounds the per-key groups of the stateful forms."""
    reader = spark.readStream if stream else spark.read
    r = (reader.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", ",".join(topics)).option("startingOffsets", starting))
    if stream and max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    if read_committed:
        r = r.option("kafka.isolation.level", "read_committed")
    if ending and not stream:
        r = r.option("endingOffsets", ending)
    df = r.option("includeHeaders", "true").load()
    return df.select("topic", F.col("key").cast("string").alias("key"),
                     F.col("value").cast("string").alias("value"), "partition", "offset",
                     instant_to_ntz(F.col("timestamp")).alias("timestamp"), "headers")


def scan_topic(log: DataFrame, topic: str) -> DataFrame:
    """S-1: one topic of a log."""
    return log.filter(F.col("topic") == topic)


def scan_topics(log: DataFrame, topics: list[str]) -> DataFrame:
    """S-2: several topics of one log."""
    return log.filter(F.col("topic").isin(*topics))


def union_topics(frames: dict[str, DataFrame]) -> DataFrame:
    """S-2: separately stored topics as one frame tagged with the topic name."""
    out = None
    for name, df in frames.items():
        tagged = df.withColumn("topic", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def replay_from_offsets(log: DataFrame, starts: DataFrame, from_beginning: list[int] | None = None) -> DataFrame:
    """S-3: rows at or after a per-(topic, partition) start offset.

    ``starts`` has ``topic, partition, from_offset``, one row per partition.
    Partitions not listed are read from the beginning; with ``from_beginning``
    only those it names are, and others are skipped.
    """
    s = starts.select("topic", "partition", "from_offset")
    j = log.join(s, ["topic", "partition"], "left")
    unlisted = F.col("from_offset").isNull()
    if from_beginning is not None:
        unlisted = unlisted & F.col("partition").isin(*from_beginning)
    return j.filter((F.col("offset") >= F.col("from_offset")) | unlisted).drop("from_offset")


def read_first_n(log: DataFrame, n: int) -> DataFrame:
    """S-4: the first ``n`` messages in (partition, offset) order (a top-k)."""
    return log.orderBy("topic", "partition", "offset").limit(n)


def assign_batches(log: DataFrame, batch_size: int) -> DataFrame:
    """S-5: micro-batch id per (topic, partition): position // batch_size.
    Positions come from the skew-safe scan, so offset gaps are fine."""
    pos = row_positions(log, ["topic", "partition"], ["offset"], name="__pos")
    return pos.withColumn("batch_id", F.floor(F.col("__pos") / batch_size).cast("long")).drop("__pos")


def decode_json(log: DataFrame, schema: T.StructType, value: str = "value",
                keep: list[str] | None = None) -> DataFrame:
    """S-6: parse ``value`` with ``schema``; ``decoded`` is false for bad rows.

    Parsing is PERMISSIVE (no job failure); a row is bad when the text is not
    a JSON object, or does not end with it.  An amount that is no number is null
    and its row good.  Callers split with ``filter(decoded)`` / ``~decoded`` (F-3).
    """
    keep = keep if keep is not None else [c for c in log.columns if c != value]
    as_text = [T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DecimalType) else f.dataType) for f in schema.fields]
    with_bad = T.StructType(as_text + [T.StructField("_corrupt_record", T.StringType())])
    parsed = F.from_json(F.col(value), with_bad,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    out = log.select(*keep, F.col(value), parsed.alias("__d"))
    ok = F.col(value).isNotNull() & F.col("__d._corrupt_record").isNull() & F.rtrim(value).endswith("}")
    return out.select(*keep, F.col(value), *[F.col(f"__d.{f.name}").try_cast(f.dataType).alias(f.name) for f in schema.fields],
                      ok.alias("decoded"))


def cdc_apply(changes: DataFrame, key: str = "key", order: list[str] | None = None) -> DataFrame:
    """S-8 / A-4: apply a change stream (ops c/r/u/d) to get the current rows.
    The latest change per key wins; a delete (or null ``after``) removes it."""
    from eventide.operators.tables import compact_latest
    order = order or ["ts_ms", "seq"]
    tomb = (F.col("op") == "d") | F.col("after").isNull()
    return compact_latest(changes, [key], order, tombstone=tomb)
