"""Keyed stream operators on Spark's state API v2 (T-1, A-2, J-2/J-3).

Each operator is a ``StatefulProcessor`` on ``transformWithStateInPandas``:
values, lists and maps of a key live in the RocksDB state store, event-time
timers say when the watermark has passed something that waits there.

Rows may arrive in any order within the watermark's delay.  What depends on the
order (running window values, the profile an order sees) waits until the
watermark has passed it; then every row before it has come, so the stream gives
what the batch operator gives on the same rows.  A row is late when its
millisecond is at or before the watermark; late rows come out marked, for a side
output, and change nothing that has been emitted.

Keys are dealt to ``BUCKETS`` groups by their hash, and a group's rows are worked on
as columns: a call of the state API is a message to the JVM, so one per key and
value costs far more than the work itself.  What is kept of many keys in one value
is a small Arrow table.  A processor also takes one key alone: where the rows do
not name it, the group's key does.

The batches of a group are read one by one and kept as numbers, so a key with a
million rows in a micro-batch needs some tens of megabytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eventide import schemas as S
from eventide.functions.columns import EPOCH_NTZ, ntz_to_instant, ntz_to_micros

#: rows of an emitted frame
SLICE = 10_000
#: groups that keys are dealt to; a running stream keeps its number
BUCKETS = 512
_NO_TIME = -(2**63)


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _store(spark: SparkSession) -> None:
    """The state API needs a store of several column families, which of Spark's own is RocksDB: set where a session has not."""
    if "RocksDB" not in spark.conf.get(_PROVIDER, ""):
        spark.conf.set(_PROVIDER, _ROCKSDB)


def from_micros(us: str) -> Column:
    return F.timestamp_add("MICROSECOND", F.col(us), F.lit(EPOCH_NTZ).cast("timestamp_ntz"))


def _none(values) -> list:
    """Values as Python objects, missing ones as None."""
    return [None if v is None or v != v else v for v in values]


class _Codes:
    """Small numbers for the strings of a column."""

    def __init__(self, known: list[str | None] = ()):
        self.names: list[str | None] = []
        self.number: dict[str | None, int] = {}
        self.of(known)

    def of(self, values) -> np.ndarray:
        out = np.empty(len(values), np.int32)
        for i, v in enumerate(_none(values)):
            n = self.number.get(v)
            if n is None:
                n = self.number[v] = len(self.names)
                self.names.append(v)
            out[i] = n
        return out

    def text(self, codes: np.ndarray) -> np.ndarray:
        return np.array(self.names, object)[codes]


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _named(pdf: pd.DataFrame, column: str, key: tuple) -> pd.DataFrame:
    """Rows with their key's name: their own, or that of the group."""
    return pdf if column in pdf.columns else pdf.assign(**{column: key[0]})


def _packed(frame: pd.DataFrame, schema: pa.Schema) -> list[bytes]:
    """Rows as Arrow tables of at most ``SLICE`` rows."""
    out = []
    for lo in range(0, len(frame), SLICE):
        part, sink = frame.iloc[lo:lo + SLICE], pa.BufferOutputStream()
        batch = pa.RecordBatch.from_arrays([pa.array(part[f.name], f.type, from_pandas=True) for f in schema], schema=schema)
        with pa.ipc.new_stream(sink, schema) as writer:
            writer.write_batch(batch)
        out.append(sink.getvalue().to_pybytes())
    return out


def _unpacked(tables: list[bytes], schema: pa.Schema) -> pd.DataFrame:
    return pa.concat_tables([schema.empty_table(), *[pa.ipc.open_stream(pa.py_buffer(t)).read_all() for t in tables]]).to_pandas()


def _first_of(codes: np.ndarray) -> np.ndarray:
    """Of rows sorted by ``codes``, the place at which each one's run begins."""
    begins = np.r_[True, codes[1:] != codes[:-1]][:len(codes)]
    return np.maximum.accumulate(np.where(begins, np.arange(len(codes)), 0))


# T-1 ---------------------------------------------------------------------------------
CHANGES = ("order_id string, customer_id string, event_id long, us long, previous_status string, new_status string, "
           "accepted boolean")


class OrderStates(StatefulProcessor):
    """T-1: the status of an order (``ValueState``) and its accepted transitions (``ListState``).

    Requests of a micro-batch are taken by (time, event id), rows without time
    first; micro-batches in the order they come.
    """

    def __init__(self, transitions: dict[str, list[str]], initial: str):
        self.transitions, self.initial = transitions, initial

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.status = handle.getValueState("status", "status string")
        self.history = handle.getListState("history", "from_status string, to_status string, event_id long, at_us long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kinds, customers, orders = _Codes([self.initial, *self.transitions]), _Codes(), _Codes()
        of, us, ids, asked, who = [], [], [], [], []
        for pdf in rows:  # one batch at a time, as numbers
            of.append(orders.of(pdf["order_id"].to_numpy(object) if "order_id" in pdf.columns else [key[0]] * len(pdf)))
            us.append(pdf["us"].to_numpy(np.int64))
            ids.append(pdf["event_id"].to_numpy(np.int64))
            asked.append(kinds.of(pdf["requested_status"].to_numpy(object)))
            who.append(customers.of(pdf["customer_id"].to_numpy(object)))
        of, us, ids, asked, who = (np.concatenate(x) for x in (of, us, ids, asked, who))
        order = np.lexsort((ids, us, of))
        allowed = {kinds.number[a]: {kinds.number[b] for b in bs if b in kinds.number} for a, bs in self.transitions.items()}
        held = [self._status(name) for name in orders.names]
        now = kinds.of([self.initial if h is None else h for h in held]).tolist()
        for lo in range(0, len(order), SLICE):
            at = order[lo:lo + SLICE]
            prev, ok = np.empty(len(at), np.int32), np.zeros(len(at), bool)
            for i, (o, request) in enumerate(zip(of[at].tolist(), asked[at].tolist())):  # a fold: each step needs the status before
                prev[i] = now[o]
                if request in allowed.get(now[o], ()):
                    ok[i], now[o] = True, request
            out = pd.DataFrame({
                "order_id": orders.text(of[at]), "customer_id": customers.text(who[at]), "event_id": ids[at], "us": us[at],
                "previous_status": kinds.text(prev), "new_status": kinds.text(asked[at]), "accepted": ok})
            done = out[ok]
            if len(done):
                self._accepted(done)
            yield out
        for name, before, code in zip(orders.names, held, now):
            if kinds.names[code] != before:
                self._keep(name, kinds.names[code])

    def _status(self, order_id: str | None) -> str | None:
        return self.status.get()[0] if self.status.exists() else None

    def _keep(self, order_id: str | None, status: str) -> None:
        self.status.update((status,))

    def _accepted(self, done: pd.DataFrame) -> None:
        self.history.appendList(list(zip(done["previous_status"], done["new_status"], done["event_id"].tolist(), done["us"].tolist())))

    def close(self) -> None:
        pass


class OrderStatesOfBucket(OrderStates):
    """T-1 of many orders: a ``MapState`` of their statuses, a ``ListState`` of their accepted transitions."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.status = handle.getMapState("status", "order_id string", "status string")
        self.history = handle.getListState(
            "history", "order_id string, from_status string, to_status string, event_id long, at_us long")

    def _status(self, order_id: str | None) -> str | None:
        held = self.status.getValue((order_id,))
        return None if held is None else held[0]

    def _keep(self, order_id: str | None, status: str) -> None:
        self.status.updateValue((order_id,), (status,))

    def _accepted(self, done: pd.DataFrame) -> None:
        self.history.appendList(list(zip(done["order_id"], done["previous_status"], done["new_status"], done["event_id"].tolist(),
                                         done["us"].tolist())))


def order_state_stream(requests: DataFrame, transitions: dict | None = None, initial: str = S.INITIAL_STATUS) -> DataFrame:
    """T-1 streaming: previous and new status, accepted and reason of every request.

    Status is kept without expiry: a late request for a finished order must be
    rejected against its final status.  ``order_history`` reads the transitions.
    """
    _store(requests.sparkSession)
    # no nulls among the numbers: with one, pandas would read its whole batch as doubles
    rows = requests.select("order_id", "customer_id", F.coalesce("event_id", F.lit(_NO_TIME)).alias("event_id"), "requested_status",
                           F.coalesce(ntz_to_micros(F.col("ts")), F.lit(_NO_TIME)).alias("us"), _bucket("order_id").alias("bucket"))
    out = rows.groupBy("bucket").transformWithStateInPandas(
        OrderStatesOfBucket(transitions or S.VALID_TRANSITIONS, initial), CHANGES, "Append", "None")
    refused = F.concat(F.lit("Invalid: "), F.col("previous_status"), F.lit(" -> "), F.coalesce("new_status", F.lit("null")))
    return out.select("order_id", "customer_id", "event_id", _time("us").alias("ts"), "previous_status", "new_status",
                      "accepted", F.when(~F.col("accepted"), refused).alias("reason"))


def _time(us: str) -> Column:
    return F.when(F.col(us) != _NO_TIME, from_micros(us))


def order_history(spark: SparkSession, checkpoint: str) -> DataFrame:
    """W-2 from the running stream's state: the accepted transitions of every order, as its checkpoint holds them."""
    state = spark.read.format("statestore").option("stateVarName", "history").load(checkpoint)
    return state.select("list_element.order_id", "list_element.event_id", "list_element.from_status", "list_element.to_status",
                        _time("list_element.at_us").alias("at"))


def order_statuses(spark: SparkSession, checkpoint: str) -> DataFrame:
    """T-2 from the running stream's state: the current status of every order."""
    state = spark.read.format("statestore").option("stateVarName", "status").load(checkpoint)
    return state.select("user_map_key.order_id", F.col("user_map_value.status").alias("current_status"))


# A-2 ---------------------------------------------------------------------------------
ALERTS = ("customer_id string, order_id string, order_count long, total_cents long, region_count long, window_us long, "
          "us long, late boolean")
_WINDOW = "totals array<binary>, regions array<binary>, waiting array<binary>"
_TOTALS = pa.schema([("customer_id", pa.string()), ("order_count", pa.int64()), ("cents", pa.int64())])
_REGIONS = pa.schema([("customer_id", pa.string()), ("region", pa.string())])
_WAITING = pa.schema([("customer_id", pa.string()), ("us", pa.int64()), ("order_id", pa.string()), ("cents", pa.int64()),
                      ("region", pa.string())])


class RunningWindows(StatefulProcessor):
    """A-2: running order statistics of customers' tumbling windows.

    A ``MapState`` entry per open window holds the counts of each customer so
    far, the regions each has been in, and the orders that wait for the
    watermark.  Timers fire at the earliest waiting order, and at a window's end,
    when it leaves the state.
    """

    def __init__(self, window_us: int):
        self.window_us = window_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "start_us long", _WINDOW)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        waiting: dict[int, list[pd.DataFrame]] = {}
        for pdf in rows:
            pdf = _named(pdf[pdf["order_id"].notna()], "customer_id", key)  # a heartbeat is no order
            late = (pdf["us"] // 1000 <= watermark).to_numpy(bool)
            if late.any():
                own = pdf[late]
                yield pd.DataFrame({"customer_id": own["customer_id"], "order_id": own["order_id"], "order_count": None,
                                    "total_cents": None, "region_count": None, "window_us": own["us"] - own["us"] % self.window_us,
                                    "us": own["us"], "late": True})
                pdf = pdf[~late]
            for start, own in pdf.groupby(pdf["us"] - pdf["us"] % self.window_us):
                waiting.setdefault(int(start), []).append(own)
        for start, parts in waiting.items():
            totals, regions, held = self.windows.getValue((start,)) or ([], [], [])
            self.windows.updateValue((start,), (totals, regions, [*held, *_packed(pd.concat(parts), _WAITING)]))
        if waiting:
            self.handle.registerTimer(min(int(p["us"].min()) for parts in waiting.values() for p in parts) // 1000)

    def _advance(self, totals: pd.DataFrame, regions: pd.DataFrame, due: pd.DataFrame) -> tuple[pd.DataFrame, ...]:
        """(rows of ``due`` with their running values, totals and regions after them)."""
        customers, places = _Codes(totals["customer_id"].to_numpy(object)), _Codes([None])
        due = due.assign(who=customers.of(due["customer_id"].to_numpy(object))).sort_values(["who", "us", "order_id"], kind="stable")
        who, cents = due["who"].to_numpy(), due["cents"].to_numpy()
        more = len(customers.names) - len(totals)
        count, total = (np.concatenate([totals[c].to_numpy(np.int64), np.zeros(more, np.int64)]) for c in ("order_count", "cents"))
        # a pair of customer and region counts where it is met first
        seen = customers.of(regions["customer_id"].to_numpy(object)).astype(np.int64), places.of(regions["region"].to_numpy(object))
        place = places.of(due["region"].to_numpy(object))
        pair, before = who.astype(np.int64) * len(places.names) + place, seen[0] * len(places.names) + seen[1]
        _, first_met = np.unique(pair, return_index=True)
        new = np.zeros(len(due), bool)
        new[first_met] = True
        new &= (place > 0) & ~np.isin(pair, before)
        n_regions = np.bincount(seen[0], minlength=len(customers.names))
        first = _first_of(who)
        upto = lambda v: np.cumsum(v) - (np.cumsum(v) - v)[first]  # noqa: E731 - sums within a customer
        rows = pd.DataFrame({
            "customer_id": customers.text(who), "order_id": due["order_id"].to_numpy(object),
            "order_count": count[who] + 1 + np.arange(len(due)) - first, "total_cents": total[who] + upto(cents),
            "region_count": n_regions[who] + upto(new.astype(np.int64)), "us": due["us"].to_numpy()})
        last = np.flatnonzero(np.r_[who[1:] != who[:-1], True])
        count[who[last]], total[who[last]] = rows["order_count"].to_numpy()[last], rows["total_cents"].to_numpy()[last]
        after = pd.DataFrame({"customer_id": np.array(customers.names, object), "order_count": count, "cents": total})
        met = pd.DataFrame({"customer_id": rows["customer_id"].to_numpy(object)[new], "region": places.text(place[new])})
        return rows, after, pd.concat([regions, met])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark, following = timerValues.getCurrentWatermarkInMs(), []
        for (start,) in sorted(tuple(k) for k in self.windows.keys()):
            if start // 1000 > watermark:
                following.append(start // 1000)  # nothing of it is due; its first order may be later still
                continue
            totals, regions, waiting = self.windows.getValue((start,))
            held = _unpacked(waiting, _WAITING)
            due = (held["us"] // 1000 <= watermark).to_numpy(bool)
            if due.any():
                rows, after, met = self._advance(_unpacked(totals, _TOTALS), _unpacked(regions, _REGIONS), held[due])
                rows = rows.assign(window_us=start, late=False)
                for lo in range(0, len(rows), SLICE):
                    yield rows.iloc[lo:lo + SLICE][["customer_id", "order_id", "order_count", "total_cents", "region_count",
                                                    "window_us", "us", "late"]]
                held = held[~due]
            end = (start + self.window_us) // 1000
            if end <= watermark:
                self.windows.removeKey((start,))
                continue
            if due.any():
                self.windows.updateValue((start,), (_packed(after, _TOTALS), _packed(met, _REGIONS), _packed(held, _WAITING)))
            following.append(min(end, int(held["us"].min()) // 1000) if len(held) else end)
        if following:
            self.handle.registerTimer(min(following))

    def close(self) -> None:
        pass


def running_windows_stream(orders: DataFrame, window_seconds: int, delay_seconds: int) -> DataFrame:
    """A-2 streaming: (customer_id, order_id, order_count, total_amount, region_count, window_start, window_end, late).

    One row per order, once the watermark (the newest time seen less
    ``delay_seconds``) has passed it: the values of its window up to it, by
    (time, order id).  Late orders come out at once with ``late`` set and no
    values, and count nowhere.  Orders without time are left out, rows without
    order id only move the watermark.
    """
    _store(orders.sparkSession)
    timed = orders.select(
        "customer_id", "order_id", "region", ntz_to_micros(F.col("placed_at")).alias("us"),
        F.coalesce((F.col("amount") * 100).cast("long"), F.lit(0)).alias("cents"),
        _bucket("customer_id").alias("bucket"), ntz_to_instant(F.col("placed_at")).alias("__event_time")).filter("us is not null")
    # the watermark column ends here: with it, Spark would drop late rows before the operator sees them
    rows = timed.withWatermark("__event_time", f"{delay_seconds} seconds").drop("__event_time")
    out = rows.groupBy("bucket").transformWithStateInPandas(
        RunningWindows(window_seconds * 1_000_000), ALERTS, "Append", "EventTime")
    return out.select(
        "customer_id", "order_id", "order_count", (F.col("total_cents").cast("decimal(20,0)") / 100).cast(S.MONEY_SUM).alias("total_amount"),
        "region_count", from_micros("window_us").alias("window_start"),
        F.timestamp_add("SECOND", F.lit(window_seconds), from_micros("window_us")).alias("window_end"), "late",
        from_micros("us").alias("placed_at"))


# J-2 / J-3 -----------------------------------------------------------------------------
ENRICHED = "customer_id string, us long, payload string, name string, email string, tier string, kind string, late boolean"


_VERSIONS = pa.schema([("customer_id", pa.string()), ("us", pa.int64()), ("email", pa.string()), ("name", pa.string()),
                       ("tier", pa.string())])
_ORDERS = pa.schema([("customer_id", pa.string()), ("us", pa.int64()), ("payload", pa.string())])


class ProfileAsOf(StatefulProcessor):
    """J-2/J-3: orders take the profile valid at their own time.

    Profile versions of customers are a ``ListState``, orders wait in another.
    Once the watermark has passed an order, every version up to it has come: it
    takes the last of them.  Versions that no later order can see any more are
    removed.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.versions = handle.getListState("versions", "rows binary")
        self.orders = handle.getListState("orders", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark, first = timerValues.getCurrentWatermarkInMs(), None
        for pdf in rows:
            pdf = _named(pdf[pdf["kind"].notna()], "customer_id", key)  # a heartbeat is no row
            if not len(pdf):
                continue
            us, profile = pdf["us"].to_numpy(np.int64), (pdf["kind"] == "profile").to_numpy(bool)
            late = us // 1000 <= watermark
            if late.any():
                yield pdf.loc[late, ["customer_id", "us", "payload", "name", "email", "tier", "kind"]].assign(late=True)
            for state, own, schema in ((self.versions, profile, _VERSIONS), (self.orders, ~profile & ~late, _ORDERS)):
                if own.any():
                    state.appendList([(t,) for t in _packed(pdf[own], schema)])
            if not late.all():
                low = int(us[~late].min())
                first = low if first is None else min(first, low)
        if first is not None:
            self.handle.registerTimer(first // 1000)

    @staticmethod
    def _replace(state, frame: pd.DataFrame, schema: pa.Schema) -> None:
        if len(frame):
            state.put([(t,) for t in _packed(frame, schema)])
        else:
            state.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark, customers = timerValues.getCurrentWatermarkInMs(), _Codes()
        tables = [t for (t,) in self.versions.get()]
        versions = _unpacked(tables, _VERSIONS)
        # of one customer and time, the last by (email, name, tier), nulls first
        versions = versions.assign(who=customers.of(versions["customer_id"].to_numpy(object))).sort_values(
            ["who", "us", "email", "name", "tier"], na_position="first").drop_duplicates(["who", "us"], keep="last")
        orders = _unpacked([t for (t,) in self.orders.get()], _ORDERS)
        due = (orders["us"] // 1000 <= watermark).to_numpy(bool)
        whose, times = versions["who"].to_numpy(), versions["us"].to_numpy(np.int64)
        if due.any():
            yield from self._seen(versions, orders[due], customers)
            orders = orders[~due]
            self._replace(self.orders, orders, _ORDERS)
        past = times // 1000 <= watermark
        gone = np.r_[past[:-1] & past[1:] & (whose[:-1] == whose[1:]), False][:len(past)]  # the last passed version of each stays
        if gone.any() or len(tables) > -(-len(versions) // SLICE):
            self._replace(self.versions, versions[~gone], _VERSIONS)
        following = np.concatenate([times[~past], orders["us"].to_numpy(np.int64)])
        if len(following):
            self.handle.registerTimer(int(following.min()) // 1000)

    @staticmethod
    def _seen(versions: pd.DataFrame, orders: pd.DataFrame, customers: _Codes) -> Iterator[pd.DataFrame]:
        """Orders with the last version of their customer up to their time."""
        own = customers.of(orders["customer_id"].to_numpy(object))
        who, us = np.concatenate([versions["who"].to_numpy(), own]), np.concatenate([versions["us"].to_numpy(), orders["us"].to_numpy()])
        is_order = np.arange(len(who)) >= len(versions)
        by = np.lexsort((is_order, us, who))  # a version goes before the orders of its time
        last = np.maximum.accumulate(np.where(is_order[by], -1, np.arange(len(by))))
        at, seen = by[is_order[by]] - len(versions), by[last[is_order[by]]]
        # a row without customer belongs to none, so it sees no profile
        sees = (last[is_order[by]] >= 0) & (who[seen] == own[at]) & orders["customer_id"].notna().to_numpy()[at]
        got = {c: np.append(versions[c].to_numpy(object), None)[np.where(sees, seen, len(versions))] for c in ("name", "email", "tier")}
        rows = orders.iloc[at].assign(**got, kind="order", late=False)
        for lo in range(0, len(rows), SLICE):
            yield rows.iloc[lo:lo + SLICE][["customer_id", "us", "payload", "name", "email", "tier", "kind", "late"]]

    def close(self) -> None:
        pass


#: times in a payload keep their microseconds
_JSON = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def order_payload(orders: DataFrame) -> Column:
    """A whole order as JSON, as ``asof_enrichment_stream`` takes it."""
    return F.to_json(F.struct(*orders.columns), _JSON)


def asof_enrichment_stream(events: DataFrame, order_schema: T.StructType, delay_seconds: int, enriched_at: Column | None = None) -> DataFrame:
    """J-2/J-3 streaming: enriched orders, and late rows, of one stream of both kinds.

    ``events`` has ``kind`` (order or profile), ``customer_id``, ``at`` (its
    time) and, for orders, ``payload`` (by ``order_payload``, with the columns of
    ``order_schema``), for profiles ``name``, ``email`` and ``tier``.  Columns:
    those of an enriched order, ``kind`` and ``late``.  Late orders come out
    unenriched; late profiles come out too, and are seen by orders that still
    wait.  Rows without time are left out; those without kind only move the
    watermark.
    """
    from eventide.operators.joins import _enriched_columns
    _store(events.sparkSession)
    timed = events.select("kind", "customer_id", "payload", "name", "email", "tier", ntz_to_micros(F.col("at")).alias("us"),
                          _bucket("customer_id").alias("bucket"), ntz_to_instant(F.col("at")).alias("__event_time")).filter("us is not null")
    rows = timed.withWatermark("__event_time", f"{delay_seconds} seconds").drop("__event_time")
    out = rows.groupBy("bucket").transformWithStateInPandas(ProfileAsOf(), ENRICHED, "Append", "EventTime")
    order = F.from_json("payload", order_schema, _JSON)
    got = out.select(F.col("customer_id").alias("__customer"), order.alias("__o"), "kind", "late",
                     *[F.col(c).alias(f"__p_{c}") for c in ("name", "email", "tier")]).select(
        "__o.*", "kind", "late", "__p_name", "__p_email", "__p_tier")
    return got.select(*_enriched_columns(got, enriched_at, S.HIGH_VALUE_THRESHOLD), "kind", "late")
