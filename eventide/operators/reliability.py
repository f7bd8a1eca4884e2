"""D-1 .. D-5: retries, backoff schedule, dead letters, redrive, totals.

Two forms:

* ``process_with_retry`` runs a user function per record on the executors
  (``mapInPandas``) with up to ``max_retries`` attempts; permanent error
  classes stop at once.  Waiting between attempts is optional: at scale the
  retry table (``retry_schedule`` / ``redrive_due``) is the better way to
  retry, because a sleeping task holds an executor slot.
* ``dead_letters`` / ``process_outcomes`` evaluate rule-based failures as
  Column expressions (no Python), so the same routing is checkable in SQL.
"""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide import schemas as S
from eventide.operators.transforms import classify_error, classify_names, is_retryable

OUTCOME_FIELDS = [
    T.StructField("ok", T.BooleanType()),
    T.StructField("attempts", T.IntegerType()),
    T.StructField("error_type", T.StringType()),
    T.StructField("error_message", T.StringType()),
]


def _raised(process_fn: Callable[[dict], None], row: dict) -> Exception | None:
    try:
        process_fn(row)
    except Exception as e:  # noqa: BLE001 - user code
        return e
    return None


def process_with_retry(df: DataFrame, process_fn: Callable[[dict], None],
                       max_retries: int = S.MAX_RETRIES, backoff_ms: int = S.RETRY_BACKOFF_MS,
                       sleep: bool = False) -> DataFrame:
    """D-1: run ``process_fn`` on every record in rounds of attempts; add ok /
    attempts / error_type / error_message.

    A round tries the batch's records that are still open; those whose error is
    permanent are closed, the others stay for the next round.  The record handed
    to the function has the number of the attempt as ``attempt``.  With
    ``sleep`` a task waits once before each further round, twice as long each
    time."""
    schema = T.StructType(df.schema.fields + OUTCOME_FIELDS)

    def run(batches):
        for pdf in batches:
            out = pdf.assign(ok=False, attempts=pd.Series(0, index=pdf.index, dtype="int32"), error_type=None, error_message=None)
            still_open = pd.Series(True, index=pdf.index)
            for attempt in range(1, max_retries + 1):
                rows = pdf[still_open]
                if rows.empty:
                    break
                if sleep and attempt > 1:
                    time.sleep(backoff_ms / 1000.0 * 2 ** (attempt - 2))
                errors = pd.Series([_raised(process_fn, {**row, "attempt": attempt}) for row in rows.to_dict("records")],
                                   index=rows.index, dtype=object)
                names = errors.map(lambda e: type(e).__name__, na_action="ignore")
                out.loc[rows.index, "attempts"] = attempt
                out.loc[rows.index, "ok"] = errors.isna()
                out.loc[rows.index, "error_type"] = classify_names(names)
                out.loc[rows.index, "error_message"] = errors.map(str, na_action="ignore")
                still_open[rows.index] = errors.notna() & ~out.loc[rows.index, "error_type"].isin(S.PERMANENT_ERRORS)
            out[["error_type", "error_message"]] = out[["error_type", "error_message"]].astype(object).where(~out["ok"], None)
            yield out
    return df.mapInPandas(run, schema)


def process_outcomes(df: DataFrame, error_name: str = "error_name", fail_times: str = "fail_times",
                     max_retries: int = S.MAX_RETRIES) -> DataFrame:
    """Rule form of D-1: a record raising ``error_name`` ``fail_times`` times
    in a row, then succeeding.  Same attempt logic, as Columns."""
    et = classify_error(F.col(error_name))
    fails = F.coalesce(F.col(fail_times), F.lit(0))
    clean = F.col(error_name).isNull() | (fails == 0)
    permanent = ~is_retryable(et)
    ok = clean | (~permanent & (fails < max_retries))
    attempts = (F.when(clean, F.lit(1)).when(permanent, F.lit(1))
                .when(fails < max_retries, fails + 1).otherwise(F.lit(max_retries)))
    return df.withColumns({
        "ok": ok,
        "attempts": attempts.cast("int"),
        "error_type": F.when(~ok, et),
    })


def retry_schedule(df: DataFrame, first_failure_at: str, max_retries: int = S.MAX_RETRIES,
                   backoff_ms: int = S.RETRY_BACKOFF_MS) -> DataFrame:
    """D-2: one row per retry (attempts 2..max): wait before it and when it runs."""
    k = F.explode(F.sequence(F.lit(1), F.lit(max_retries - 1))).alias("retry")
    out = df.select("*", k)
    wait = (F.lit(backoff_ms) * F.pow(F.lit(2), F.col("retry") - 1)).cast("long")
    cum = (F.lit(backoff_ms) * (F.pow(F.lit(2), F.col("retry")) - 1)).cast("long")
    return out.select("*", (F.col("retry") + 1).cast("int").alias("attempt"), wait.alias("backoff_ms"),
                      (F.col(first_failure_at) + F.make_dt_interval(secs=cum / F.lit(1000.0))).alias("retry_at")) \
              .drop("retry")


def next_retry_at(attempts: Column, first_failure_at: Column, backoff_ms: int = S.RETRY_BACKOFF_MS) -> Column:
    """When the next attempt is due after ``attempts`` tries (cumulative backoff)."""
    cum_ms = F.lit(backoff_ms) * (F.pow(F.lit(2), attempts) - 1)
    return first_failure_at + F.make_dt_interval(secs=cum_ms / F.lit(1000.0))


def redrive_due(retry_table: DataFrame, as_of: Column, error_name: str = "error_name",
                max_retries: int = S.MAX_RETRIES) -> DataFrame:
    """D-4: retryable rows whose next attempt is due and that have tries left."""
    et = classify_error(F.col(error_name))
    due = next_retry_at(F.col("attempts"), F.col("first_failure_at"))
    return (retry_table.withColumn("error_type", et).withColumn("next_retry_at", due)
            .filter(is_retryable(F.col("error_type")) & (F.col("attempts") < max_retries)
                    & (F.col("next_retry_at") <= as_of)))


def dead_letters(outcomes: DataFrame, topic: str = "topic", partition: str = "partition",
                 offset: str = "offset", key: str = "key", value: str = "value",
                 first_failure_at: str = "first_failure_at",
                 backoff_ms: int = S.RETRY_BACKOFF_MS) -> DataFrame:
    """D-3: the dead-letter record of every failed row (keyed by its key)."""
    bad = outcomes.filter(~F.col("ok"))
    last = next_retry_at(F.col("attempts") - 1, F.col(first_failure_at), backoff_ms)
    return bad.select(
        F.col(topic).alias("original_topic"), F.col(partition).alias("original_partition"),
        F.col(offset).cast("long").alias("original_offset"), F.col(key).alias("original_key"),
        F.col(value).cast("binary").alias("original_value"),
        F.concat(F.col("error_type"), F.lit(" after "), F.col("attempts").cast("string"),
                 F.lit(" attempt(s)")).alias("error_message"),
        "error_type", F.col("attempts").alias("retry_count"),
        F.col(first_failure_at).alias("first_failure_at"), last.alias("last_failure_at"))


def route_outcomes(outcomes: DataFrame, ok_path: str, dlq_path: str, topic: str = "topic", partition: str = "partition",
                   offset: str = "offset", key: str = "key", value: str = "value",
                   first_failure_at: str = "first_failure_at") -> None:
    """D-3 routing: rows that came through go to ``ok_path``, dead letters to
    ``dlq_path`` as records of the dead-letter topic, keyed by the original key
    and with headers ``original_topic`` and ``failure_reason``.  Both writes
    replace what a lost attempt left."""
    outcomes.filter("ok").write.mode("overwrite").parquet(ok_path)
    dead = dead_letters(outcomes, topic, partition, offset, key, value, first_failure_at)
    headers = F.create_map(F.lit("original_topic"), F.col("original_topic"), F.lit("failure_reason"), F.lit(S.DLQ_REASON))
    dead.select(F.lit(S.DLQ_TOPIC).alias("topic"), F.col("original_key").alias("key"), "*", headers.alias("headers")) \
        .write.mode("overwrite").parquet(dlq_path)


def dlq_summary(outcomes: DataFrame) -> DataFrame:
    """D-5: processed and dead-lettered totals."""
    return outcomes.agg(F.sum(F.col("ok").cast("long")).alias("processed"),
                        F.sum((~F.col("ok")).cast("long")).alias("dlq_count"))
