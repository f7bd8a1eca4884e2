"""Skew-safe ordered scans per key (running sums, finite-state folds).

A running value per key ("count so far", "state after this request") is a
prefix scan.  ``Window.partitionBy(key)`` alone would put every row of a key
into one task, so a key holding a third of the data would make one
straggler task.  These helpers split hot keys instead:

1. Rows are counted per key (a partial-aggregating ``groupBy``).  Keys with
   at most ``max_chunk_rows`` rows are scanned by a plain window.
2. Rows of the others are range-partitioned on (key, order columns) and
   written to the shared checkpoint folder with the number of their range.
   A range of a key is a chunk: contiguous in the order, about equal in rows
   whatever the columns hold (nulls, bursts at one time, text), and the same
   for every later step and task retry, because it is read from the table.
3. Inside each (key, chunk) the scan runs locally: a JVM window for sums, a
   vectorised Arrow batch scan for state machines.  A chunk takes a carry from
   the key's earlier chunks; that table has a row per chunk.

Nulls of the order columns come first in all of these, as in any Spark sort,
so the result does not depend on where a key is cut.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.session import scratch_path

CHUNK = "__chunk"
KEY = "__key"
DEFAULT_MAX_CHUNK_ROWS = 2_000_000


def split_hot(df: DataFrame, keys: list[str], order: list[str], max_chunk_rows: int = DEFAULT_MAX_CHUNK_ROWS,
              every_key: bool = False) -> tuple[DataFrame | None, DataFrame | None]:
    """(rows of keys that are scanned whole, rows of split keys); ``None`` where there are none.

    Both have ``__key`` (a struct of the key columns, so that null keys compare
    equal in joins); rows of split keys are a written table and have ``__chunk``.
    ``every_key`` splits all keys (for a key that is one constant).  ``order``
    must tell all rows of a key apart.
    """
    base = df.withColumn(KEY, F.struct(*keys))
    counts = base.groupBy(KEY).agg(F.count(F.lit(1)).alias("__n"))
    hot = counts if every_key else counts.filter(F.col("__n") > max_chunk_rows)
    rows = hot.agg(F.sum("__n")).first()[0]
    if not rows:
        return (None if every_key else base), None
    picked, rest = base, None
    if not every_key:
        picked = base.join(hot.select(KEY), KEY, "left_semi")
        rest = base.join(hot.select(KEY), KEY, "left_anti")
    # twice as many ranges as needed: their sizes are sampled
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), -(-2 * rows // max_chunk_rows))
    path = scratch_path(df.sparkSession, "scan-chunks")
    laid = picked.repartitionByRange(parts, KEY, *order).withColumn(CHUNK, F.spark_partition_id())
    laid.write.parquet(path)
    return rest, df.sparkSession.read.schema(laid.schema).parquet(path)


def running_sums(df: DataFrame, keys: list[str], order: list[str],
                 values: dict[str, Column | str], max_chunk_rows: int = DEFAULT_MAX_CHUNK_ROWS,
                 inclusive: bool = True, agg: str = "sum", every_key: bool = False) -> DataFrame:
    """Add ``name = sum(value)`` over rows of the same key up to this row (with
    ``agg="max"`` the largest, with ``agg="last"`` the last that is not null).

    ``order`` must totally order the rows of a key (end it with a unique id);
    nulls come first.  With ``inclusive=False`` the current row is excluded.
    """
    fn = {"sum": F.sum, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}[agg]
    vals = {n: (F.col(v) if isinstance(v, str) else v) for n, v in values.items()}
    base = df.select("*", *[c.alias(f"__v_{n}") for n, c in vals.items()])
    whole, split = split_hot(base, keys, order, max_chunk_rows, every_key)
    upto = Window.currentRow if inclusive else -1

    def local(rows: DataFrame, *by: str) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, upto)
        return rows.select("*", *[fn(f"__v_{n}").over(w).alias(f"__l_{n}") for n in vals])

    def out(rows: DataFrame, carried: bool) -> DataFrame:
        cols = [F.col(c) for c in df.columns]
        for n in vals:
            parts = [F.col(f"__l_{n}")] + ([F.col(f"__c_{n}")] if carried else [])
            if agg == "max":
                cols.append((F.greatest(*parts) if carried else parts[0]).alias(n))
            elif agg == "last":
                cols.append(F.coalesce(*parts).alias(n))
            else:
                zero = F.lit(0).cast(base.schema[f"__v_{n}"].dataType)
                cols.append(reduce(lambda x, y: x + y, [F.coalesce(p, zero) for p in parts]).alias(n))
        return rows.select(*cols)

    result = None if whole is None else out(local(whole, KEY), False)
    if split is not None:
        def total(c: str) -> Column:  # an aggregate has no order of its own: the last is the one of the largest order
            return F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))) if agg == "last" else fn(c)
        totals = split.groupBy(KEY, CHUNK).agg(*[total(f"__v_{n}").alias(f"__t_{n}") for n in vals])
        before = Window.partitionBy(KEY).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        carry = totals.select(KEY, CHUNK, *[fn(f"__t_{n}").over(before).alias(f"__c_{n}") for n in vals])
        chunked = out(local(split, KEY, CHUNK).join(carry, [KEY, CHUNK]), True)
        result = chunked if result is None else result.unionByName(chunked)
    return out(local(base.withColumn(KEY, F.struct(*keys)), KEY), False) if result is None else result


def row_positions(df: DataFrame, keys: list[str], order: list[str], name: str = "position",
                  max_chunk_rows: int = DEFAULT_MAX_CHUNK_ROWS) -> DataFrame:
    """0-based position of each row within its key (skew-safe row_number - 1)."""
    return running_sums(df, keys, order, {name: F.lit(1).cast("long")}, max_chunk_rows, inclusive=False)


# ---------------------------------------------------------------------------
# Finite-state fold
# ---------------------------------------------------------------------------

_BITS = 4  # a function over <= 16 states is packed 4 bits per state into a long


def _pack(table: np.ndarray) -> np.ndarray:
    shifts = (np.arange(table.shape[1], dtype=np.int64) * _BITS)
    return (table.astype(np.int64) << shifts).sum(axis=1)


def _apply_packed(func: str, state: str) -> Column:
    """State index after applying the packed function column ``func`` to ``state``."""
    return F.expr(f"shiftright({func}, {_BITS} * {state}) & 15")


def transfer_table(states: list[str], transitions: dict[str, list[str]]) -> tuple[np.ndarray, dict]:
    """Row q is the function "request q" over state indexes; the last row is
    the identity (unknown request)."""
    k = len(states)
    if k > 16:
        raise ValueError("at most 16 states are supported")
    idx = {s: i for i, s in enumerate(states)}
    table = np.tile(np.arange(k, dtype=np.int64), (k + 1, 1))
    for cur, nxts in transitions.items():
        for nxt in nxts:
            table[idx[nxt], idx[cur]] = idx[nxt]
    return table, idx


def _key_of(pdf: pd.DataFrame, key_cols: list[str], i: int) -> tuple:
    """The key of a row, null the same whatever pandas makes of it."""
    return tuple(None if pd.isna(x) else x for x in (pdf[c].iloc[i] for c in key_cols))


def _dfa_batch_scanner(key_cols: list[str], symbol_col: str, states: list[str],
                       transitions: dict[str, list[str]]):
    table, idx = transfer_table(states, transitions)
    k = len(states)
    identity = np.arange(k, dtype=np.int64)

    def scan(batches):
        prev_key = None
        carry = identity.copy()  # composed function of the open segment so far
        for pdf in batches:
            n = len(pdf)
            if n == 0:
                yield pdf.assign(__fx=pd.Series([], dtype="int64"), __fi=pd.Series([], dtype="int64"))
                continue
            codes = pdf[symbol_col].map(idx).fillna(k).astype(np.int64).to_numpy()
            f = table[codes]  # (n, k): state -> state after this request
            new_seg = np.zeros(n, dtype=bool)
            for c in key_cols:
                v = pdf[c].to_numpy()
                null = pd.isna(v)
                new_seg[1:] |= (v[1:] != v[:-1]) & ~(null[1:] & null[:-1])
            first_key = _key_of(pdf, key_cols, 0)
            same_as_prev_batch = prev_key is not None and first_key == prev_key
            new_seg[0] = not same_as_prev_batch
            starts = new_seg.copy()
            starts[0] = True
            seg_id = np.cumsum(starts) - 1
            seg_start = np.flatnonzero(starts)[seg_id]
            pos = np.arange(n)
            p = f.copy()
            d = 1
            while d < n:  # Hillis-Steele prefix composition within segments
                ok = pos - d >= seg_start
                if not ok.any():
                    break
                i = pos[ok]
                p[i] = np.take_along_axis(p[i], p[i - d], axis=1)
                d *= 2
            # rows of a segment continuing from the previous batch start at `carry`
            if same_as_prev_batch:
                first = seg_id == 0
                p[first] = p[first][:, carry]
            incl = p
            excl = np.empty_like(p)
            excl[1:] = p[:-1]
            excl[new_seg] = identity
            if same_as_prev_batch:
                excl[0] = carry
            carry = incl[-1].copy()
            prev_key = _key_of(pdf, key_cols, -1)
            yield pdf.assign(__fx=_pack(excl), __fi=_pack(incl))
    return scan


def fold_states(df: DataFrame, keys: list[str], order: list[str], symbol_col: str,
                states: list[str], transitions: dict[str, list[str]], initial: str,
                state_before: str = "state_before",
                max_chunk_rows: int = DEFAULT_MAX_CHUNK_ROWS,
                initial_states: DataFrame | None = None, state_col: str = "state",
                state_after: str | None = None) -> DataFrame:
    """Run a state machine per key over rows in ``order``.

    Each row is a request to move to ``symbol_col``; it is applied when the
    edge (current -> requested) is in ``transitions``, otherwise the state is
    unchanged (unknown statuses included).  Adds ``state_before`` (the state
    the request met) and, if named, ``state_after``.

    ``initial_states`` (key columns + ``state_col``) seeds keys that already
    have a state, e.g. the state table of a stream; other keys start at
    ``initial``.
    """
    whole, split = split_hot(df, keys, order, max_chunk_rows)
    init_idx = states.index(initial)
    names = F.array(*[F.lit(s) for s in states])
    seeded = None
    if initial_states is not None:
        seed = (F.array_position(names, F.col(state_col)) - 1).cast("int")
        seeded = initial_states.select(F.struct(*[F.col(c) for c in keys]).alias(KEY),
                                       F.when(seed >= 0, seed).otherwise(F.lit(init_idx)).alias("__seed"))

    def scanned(rows: DataFrame, *by: str) -> DataFrame:
        schema = T.StructType(rows.schema.fields + [T.StructField("__fx", T.LongType()), T.StructField("__fi", T.LongType())])
        laid = rows.repartition(*by).sortWithinPartitions(*by, *order)
        return laid.mapInPandas(_dfa_batch_scanner([*keys, *by[1:]], symbol_col, states, transitions), schema)

    def started(rows: DataFrame) -> DataFrame:
        """Rows with the state index their key starts at."""
        if seeded is None:
            return rows.withColumn("__start", F.lit(init_idx))
        return rows.join(seeded, KEY, "left").withColumn("__start", F.coalesce("__seed", F.lit(init_idx))).drop("__seed")

    def out(rows: DataFrame) -> DataFrame:
        cols = [F.element_at(names, (_apply_packed("__fx", "__start") + 1).cast("int")).alias(state_before)]
        if state_after:
            cols.append(F.element_at(names, (_apply_packed("__fi", "__start") + 1).cast("int")).alias(state_after))
        return rows.select(*[F.col(c) for c in df.columns], *cols)

    result = None if whole is None else out(started(scanned(whole, KEY)))
    if split is not None:
        # scanned once and written: a chunk's composed function is that of its last row
        path, run = scratch_path(df.sparkSession, "scan-functions"), scanned(split, KEY, CHUNK)
        run.write.parquet(path)
        run = df.sparkSession.read.schema(run.schema).parquet(path)
        ends = started(run.groupBy(KEY, CHUNK).agg(F.max_by("__fi", F.struct(*order)).alias("fn")))

        def entries(pdf: pd.DataFrame) -> pd.DataFrame:
            # a row per chunk of one split key: its functions applied one after the other
            pdf = pdf.sort_values(CHUNK)
            state, at = int(pdf["__start"].iloc[0]), []
            for fn in pdf["fn"].to_numpy():
                at.append(state)
                state = int((int(fn) >> (_BITS * state)) & 15)
            return pd.DataFrame({KEY: pdf[KEY].to_numpy(), CHUNK: pdf[CHUNK].to_numpy(), "__start": np.array(at, dtype="int32")})

        schema = T.StructType([ends.schema[KEY], T.StructField(CHUNK, T.IntegerType()), T.StructField("__start", T.IntegerType())])
        chunked = out(run.join(ends.groupBy(KEY).applyInPandas(entries, schema), [KEY, CHUNK]))
        result = chunked if result is None else result.unionByName(chunked)
    return out(started(scanned(df.withColumn(KEY, F.struct(*keys)), KEY))) if result is None else result
