"""A-5, A-9, X-5, X-6 in a running stream: delivery reports, and counters observed while rows pass.

Counters are named observations of the stream itself: each micro-batch reports
them with its progress, so nothing is scanned a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from eventide import schemas as S

SUCCESS, ERROR = "success", "error"
TOO_LARGE, NO_TOPIC = "MSG_SIZE_TOO_LARGE", "UNKNOWN_TOPIC_OR_PART"
_SEP = "|"


def delivery_reports(records: DataFrame, max_bytes: int, topics: list[str] | None = None) -> DataFrame:
    """X-6: ``records`` (log rows) with ``status`` and ``error_type``: what a producer is told of each.

    A record of no known topic, or whose value has more than ``max_bytes`` bytes,
    is refused and has no offset; a null value is a tombstone of no bytes.
    """
    known = F.col("topic").isin(topics or list(S.TOPICS))
    error = (F.when(~F.coalesce(known, F.lit(False)), F.lit(NO_TOPIC))
             .when(F.coalesce(F.octet_length("value"), F.lit(0)) > max_bytes, F.lit(TOO_LARGE)))
    out = records.withColumn("error_type", error)
    ok = F.col("error_type").isNull()
    return out.withColumn("status", F.when(ok, F.lit(SUCCESS)).otherwise(F.lit(ERROR))).withColumn("offset", F.when(ok, F.col("offset")))


def produced_counters(topics: list[str] | None = None) -> dict[str, Column]:
    """A-5: one counter per label set of produced{topic,status} and produce_errors{topic,error_type}.

    Label sets are fixed: the known topics, and one for all that are not.
    """
    out = {}
    for topic in [*(topics or list(S.TOPICS)), None]:
        here = ~F.coalesce(F.col("topic").isin(topics or list(S.TOPICS)), F.lit(False)) if topic is None else F.col("topic") == topic
        for status in (SUCCESS, ERROR):
            out[_SEP.join(["produced", topic or "other", status])] = F.count_if(here & (F.col("status") == status))
        for error in (TOO_LARGE, NO_TOPIC):
            out[_SEP.join(["produce_errors", topic or "other", error])] = F.count_if(here & (F.col("error_type") == error))
    return out


def observe(stream: DataFrame, name: str, counters: dict[str, Column]) -> DataFrame:
    """``stream`` with its counters observed per micro-batch under ``name``."""
    return stream.observe(name, *[c.alias(n) for n, c in counters.items()])


class CounterLog(StreamingQueryListener):
    """Keeps what each micro-batch observes, by query and batch: a batch that is run again replaces its counts."""

    def __init__(self):
        self.seen: dict[tuple[str, int], dict[str, dict[str, int]]] = {}
        self.ended: set[str] = set()
        self.rows: dict[tuple[str, int], int] = {}
        self.duration_ms: dict[tuple[str, int], int] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        at = (str(p.id), p.batchId)
        self.rows[at], self.duration_ms[at] = p.numInputRows, p.batchDuration
        if p.observedMetrics:
            self.seen[at] = {name: row.asDict() for name, row in p.observedMetrics.items()}

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended.add(str(event.id))

    def totals(self, name: str) -> dict[str, int]:
        """Sums over all batches of the counters observed under ``name``."""
        out: dict[str, int] = {}
        for metrics in self.seen.values():
            for counter, value in metrics.get(name, {}).items():
                out[counter] = out.get(counter, 0) + value
        return out

    def wait(self, query_id: str, seconds: float = 60.0) -> None:
        """Until the query's last event has come: events come after the query has ended."""
        import time
        until = time.time() + seconds
        while query_id not in self.ended and time.time() < until:
            time.sleep(0.05)


def run_observed(stream: DataFrame, name: str, counters: dict[str, Column], out_path: str, checkpoint: str) -> CounterLog:
    """Run a stream into Spark's file sink, everything available now; the counters it reported on the way."""
    spark, log = stream.sparkSession, CounterLog()
    spark.streams.addListener(log)
    try:
        q = (observe(stream, name, counters).writeStream.outputMode("append").format("parquet").option("path", out_path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        log.wait(str(q.id))
    finally:
        spark.streams.removeListener(log)
    return log


def counter_table(spark: SparkSession, totals: dict[str, int]) -> DataFrame:
    """Counters in long form (metric, topic, label, value), those that are not 0; as many rows as label sets at most."""
    rows = [(*counter.split(_SEP), int(value)) for counter, value in totals.items() if value]
    return spark.createDataFrame(rows, "metric string, topic string, label string, value long")
