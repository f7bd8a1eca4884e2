"""Small Column builders shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventide import schemas as S


def money_from_cents(cents: Column) -> Column:
    """Exact DECIMAL(12,2) from an integral number of cents."""
    return (cents.cast("decimal(18,0)") / F.lit(100)).cast(S.MONEY)


def to_money(c: Column) -> Column:
    """Numeric or numeric string -> DECIMAL(12,2); bad input -> null (no error)."""
    return c.cast("string").try_cast(S.MONEY)


def pick(values: list, index: Column) -> Column:
    """``values[index]`` for a 0-based integer Column (null when out of range)."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.try_element_at(arr, (index + 1).cast("int"))


EPOCH_NTZ = "1970-01-01 00:00:00"


def ntz_to_micros(ts: Column) -> Column:
    """Epoch microseconds of a TIMESTAMP_NTZ (wall time read as UTC).

    By subtraction: ``timestamp_diff`` goes through the session's time zone,
    where the hour that summer time skips does not exist.
    """
    since = (ts - F.lit(EPOCH_NTZ).cast("timestamp_ntz")).cast("interval second")
    return (since.cast("decimal(24,6)") * 1_000_000).cast("long")


def ntz_to_millis(ts: Column) -> Column:
    """Epoch milliseconds of a TIMESTAMP_NTZ (wall time read as UTC)."""
    return F.floor(ntz_to_micros(ts).cast("decimal(20,0)") / 1000).cast("long")


def ntz_to_instant(ts: Column) -> Column:
    """TIMESTAMP_NTZ (UTC wall time) -> TIMESTAMP instant, independent of the
    session time zone (watermarks need TIMESTAMP)."""
    return F.timestamp_micros(ntz_to_micros(ts))


def instant_to_ntz(ts: Column) -> Column:
    """TIMESTAMP instant -> TIMESTAMP_NTZ UTC wall time (session-zone free)."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.lit(EPOCH_NTZ).cast("timestamp_ntz"))
