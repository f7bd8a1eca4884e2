"""T-2: the current state of orders from snapshots and the tail of the archive.

What a run of requests does to an order is a function: the status after it and
the number of accepted requests, for every status before it.  Such functions
compose, so an archive hour of an order is one row, a snapshot is the
composition of all hours before its cut, and the state now is the snapshot
followed by the hours since.  A late request changes its own hour's row; nothing
else is folded again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide import schemas as S
from eventide.functions.columns import pick

_PART = "order_id string, hour timestamp_ntz, part long, target array<int>, accepted array<long>, requests long"


def _tables(statuses: list[str], transitions: dict[str, list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """By request (the last one: what is no status) and status before: the status after, and 1 where that is accepted."""
    target = np.tile(np.arange(len(statuses), dtype=np.int32), (len(statuses) + 1, 1))
    accepted = np.zeros(target.shape, np.int64)
    for i, now in enumerate(statuses):
        for request in transitions.get(now, ()):
            target[statuses.index(request), i] = statuses.index(request)
            accepted[statuses.index(request), i] = 1
    return target, accepted


def _then(first: tuple[np.ndarray, np.ndarray], second: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The functions of ``first`` followed by those of ``second``, row by row."""
    return np.take_along_axis(second[0], first[0], 1), first[1] + np.take_along_axis(second[1], first[0], 1)


def _composed(target: np.ndarray, accepted: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One function per run of rows; neighbours are composed pair by pair, so a run of n rows takes log n steps."""
    run = np.zeros(len(target), np.int64)
    run[starts[1:]] = 1
    run = np.cumsum(run)
    while len(run) > 1 and (run[1:] == run[:-1]).any():
        first = np.concatenate([[True], run[1:] != run[:-1]])
        place = np.arange(len(run)) - np.maximum.accumulate(np.where(first, np.arange(len(run)), 0))
        left = np.flatnonzero(place % 2 == 0)
        paired = left[(left + 1 < len(run)) & (run[np.minimum(left + 1, len(run) - 1)] == run[left])]
        target[paired], accepted[paired] = _then((target[paired], accepted[paired]), (target[paired + 1], accepted[paired + 1]))
        target, accepted, run = target[left], accepted[left], run[left]
    return target, accepted


def _scan(statuses: list[str], transitions: dict[str, list[str]]):
    """Functions of the (order, hour) runs of sorted rows; a run that goes on in the next batch goes on in its function."""
    by_request = _tables(statuses, transitions)

    def row(open_: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([open_["order_id"]], pa.string()), pa.array([open_["hour"]], pa.timestamp("us")), pa.array([open_["part"]], pa.int64()),
             pa.array([open_["target"].tolist()], pa.list_(pa.int32())), pa.array([open_["accepted"].tolist()], pa.list_(pa.int64())),
             pa.array([open_["requests"]], pa.int64())], names=["order_id", "hour", "part", "target", "accepted", "requests"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict | None = None
        for batch in batches:
            if not len(batch):
                continue
            code = batch.column("code").to_numpy()
            same = np.ones(len(batch) - 1, bool)
            for c in ("order_id", "hour"):
                col = batch.column(c)
                a, b = col.slice(0, len(col) - 1), col.slice(1)
                equal = pc.fill_null(pc.equal(a, b), False).to_numpy(zero_copy_only=False)
                same &= equal | (a.is_null().to_numpy(zero_copy_only=False) & b.is_null().to_numpy(zero_copy_only=False))
            starts = np.concatenate([[0], np.flatnonzero(~same) + 1])
            target, accepted = _composed(by_request[0][code], by_request[1][code], starts)
            ends = np.concatenate([starts[1:], [len(batch)]])
            runs = [{"order_id": batch.column("order_id")[int(s)].as_py(), "hour": batch.column("hour")[int(s)].as_py(),
                     "part": int(batch.column("part")[0].as_py()), "target": target[i], "accepted": accepted[i], "requests": int(ends[i] - s)}
                    for i, s in enumerate(starts)]
            if last is not None and (last["order_id"], last["hour"]) == (runs[0]["order_id"], runs[0]["hour"]):
                both = _then((last["target"][None], last["accepted"][None]), (runs[0]["target"][None], runs[0]["accepted"][None]))
                runs[0].update(target=both[0][0], accepted=both[1][0], requests=last["requests"] + runs[0]["requests"])
            elif last is not None:
                runs.insert(0, last)
            last = runs.pop()
            if runs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["order_id"] for r in runs], pa.string()), pa.array([r["hour"] for r in runs], pa.timestamp("us")),
                     pa.array([r["part"] for r in runs], pa.int64()), pa.array([r["target"].tolist() for r in runs], pa.list_(pa.int32())),
                     pa.array([r["accepted"].tolist() for r in runs], pa.list_(pa.int64())), pa.array([r["requests"] for r in runs], pa.int64())],
                    names=["order_id", "hour", "part", "target", "accepted", "requests"])
        if last is not None:
            yield row(last)
    return run


def compose(functions: DataFrame, by: list[str], order: list[str], n_statuses: int) -> DataFrame:
    """(by, target, accepted, requests): the functions of a group, one after the other by ``order`` (nulls first).

    A group's rows are hours or days of one order, or the parts of one hour.
    """
    rows = F.sort_array(F.collect_list(F.struct(*order, "target", "accepted", "requests")))
    identity = F.struct(F.array(*[F.lit(i) for i in range(n_statuses)]).alias("target"),
                        F.array(*[F.lit(0).cast("long") for _ in range(n_statuses)]).alias("accepted"), F.lit(0).cast("long").alias("requests"))

    def then(a: Column, x: Column) -> Column:
        return F.struct(F.transform(a["target"], lambda s: F.get(x["target"], s)).alias("target"),
                        F.zip_with(a["accepted"], a["target"], lambda n, s: n + F.get(x["accepted"], s)).alias("accepted"),
                        (a["requests"] + x["requests"]).alias("requests"))
    return functions.groupBy(*by).agg(F.aggregate(rows, identity, then).alias("f")).select(*by, "f.target", "f.accepted", "f.requests")


def hour_functions(requests: DataFrame, statuses: list[str] = S.ORDER_STATUSES, transitions: dict | None = None) -> DataFrame:
    """One row per order and hour: order_id, hour, target, accepted, requests.

    Requests are range-partitioned on (order, hour, time, event id): an hour
    that holds a third of all rows is cut over many tasks, each of which gives
    the function of its part.  Rows without time are an hour of their own, the
    first.
    """
    code = F.coalesce(*[F.when(F.col("requested_status") == s, F.lit(i)) for i, s in enumerate(statuses)], F.lit(len(statuses)))
    keys = ["order_id", "hour", "ts", "event_id"]
    rows = requests.select("order_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "ts", "event_id", code.alias("code"))
    laid = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        "order_id", "hour", "code", F.spark_partition_id().cast("long").alias("part"))
    parts = laid.mapInArrow(_scan(statuses, transitions or S.VALID_TRANSITIONS), _PART)
    return compose(parts, ["order_id", "hour"], ["part"], len(statuses))


def write_hours(requests: DataFrame, path: str) -> None:
    """Store the hour functions of ``requests`` by day; days that are there already are replaced.

    For late requests, give all requests of their days: those days alone are written again.
    """
    day = F.coalesce(F.date_format("hour", "yyyy-MM-dd"), F.lit("0000-00-00"))  # without time: before all days
    hours = hour_functions(requests).withColumn("day", day)
    hours.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def read_hours(spark: SparkSession, path: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """Hour functions from ``since`` on, before ``until`` (hours as ``yyyy-MM-dd HH:00:00``); other days' files are not opened."""
    hours = spark.read.option("basePath", path).schema(
        "order_id string, hour timestamp_ntz, target array<int>, accepted array<long>, requests long, day string").parquet(path)
    stamp = lambda s: F.lit(s).cast("timestamp_ntz")
    if since:
        hours = hours.filter((F.col("day") >= since[:10]) & (F.col("hour") >= stamp(since)))
    if until:
        hours = hours.filter((F.col("day") <= until[:10]) & (F.col("hour").isNull() | (F.col("hour") < stamp(until))))
    return hours.drop("day")


def snapshot(hours: DataFrame, n_statuses: int = len(S.ORDER_STATUSES)) -> DataFrame:
    """One function per order: everything that ``hours`` have done to it.

    By day first and then by order, so that no list is longer than the days of the archive.
    """
    days = compose(hours.withColumn("day", F.to_date("hour")), ["order_id", "day"], ["hour"], n_statuses)
    return compose(days, ["order_id"], ["day"], n_statuses)


def current_state(before: DataFrame, tail: DataFrame, statuses: list[str] = S.ORDER_STATUSES,
                  initial: str = S.INITIAL_STATUS) -> DataFrame:
    """T-2: order_id, current_status, transitions, requests by a snapshot followed by the hours of ``tail``."""
    both = before.withColumn("no", F.lit(0)).unionByName(snapshot(tail, len(statuses)).withColumn("no", F.lit(1)))
    now = compose(both, ["order_id"], ["no"], len(statuses))
    start = statuses.index(initial)
    return now.select("order_id", pick(statuses, F.get("target", F.lit(start))).alias("current_status"),
                      F.get("accepted", F.lit(start)).alias("transitions"), "requests")
