"""T-1, T-2, W-2, J-5: the order life cycle.

Requests per order are folded through the transition table in (ts, id)
order.  The fold is a prefix scan of transition functions, so it runs as
``scan.fold_states``: hot orders are range-split into chunks, each chunk is
scanned with vectorised numpy in Arrow batches, and chunk carries (at most
two per chunk) are folded on a bounded table.  No per-order list is ever
collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide import schemas as S
from eventide.functions.scan import fold_states
from eventide.operators.joins import transition_valid


def order_state_changes(requests: DataFrame, key: str = "order_id", ts: str = "ts",
                        seq: str = "event_id", requested: str = "requested_status",
                        transitions: dict | None = None, initial: str = S.INITIAL_STATUS) -> DataFrame:
    """T-1: one result per request: previous/new status, accepted, reason.

    Rejected requests (invalid edge or unknown status) leave the state as is
    and carry ``Invalid: <current> -> <requested>``.
    """
    transitions = transitions or S.VALID_TRANSITIONS
    folded = fold_states(requests, [key], [ts, seq], requested, S.ORDER_STATUSES,
                         transitions, initial, state_before="previous_status")
    ok = transition_valid(F.col("previous_status"), F.col(requested))
    cols = [c for c in requests.columns if c != requested]
    return folded.select(
        *cols,
        F.col("previous_status"),
        F.col(requested).alias("new_status"),
        ok.alias("accepted"),
        F.when(~ok, F.concat(F.lit("Invalid: "), F.col("previous_status"), F.lit(" -> "),
                             F.coalesce(F.col(requested), F.lit("null")))).alias("reason"),
    )


def state_history(changes: DataFrame, key: str = "order_id", ts: str = "ts",
                  seq: str = "event_id") -> DataFrame:
    """W-2: the accepted transitions as ``from -> to at``.  ``from`` is the
    previous accepted status (or ``placed``), i.e. the state the request met."""
    acc = changes.filter(F.col("accepted"))
    return acc.select(F.col(key), F.col(seq), F.col("previous_status").alias("from_status"),
                      F.col("new_status").alias("to_status"), F.col(ts).alias("at"))


def order_current_state(changes: DataFrame, key: str = "order_id", ts: str = "ts",
                        seq: str = "event_id", initial: str = S.INITIAL_STATUS) -> DataFrame:
    """T-2: replay to the current state: the last accepted status per order,
    ``placed`` when nothing was accepted.  A partial-aggregating group by."""
    acc = F.col("accepted")
    g = changes.groupBy(key).agg(
        F.max_by(F.when(acc, F.col("new_status")), F.when(acc, F.struct(ts, seq))).alias("__last"),
        F.sum(acc.cast("long")).alias("transitions"),
        F.count(F.lit(1)).alias("requests"))
    return g.select(key, F.coalesce("__last", F.lit(initial)).alias("current_status"),
                    "transitions", "requests")


def transition_check(requests: DataFrame, current: str, requested: str) -> DataFrame:
    """J-5 on rows carrying their current status."""
    return requests.withColumn("valid", transition_valid(F.col(current), F.col(requested)))
