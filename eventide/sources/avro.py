"""S-7: Avro values by declared schema.

Uses Spark's ``from_avro`` / ``to_avro``, which need the external
``spark-avro`` package on the classpath.  Without it the functions raise a
clear error; JSON (``topics.decode_json``) is the default wire format.
"""

from __future__ import annotations

from pyspark.sql import Column


def _avro():
    try:
        from pyspark.sql.avro import functions as A
    except ImportError as e:  # pragma: no cover - pyspark always ships the module
        raise RuntimeError("pyspark avro functions unavailable") from e
    return A


def decode_avro(value: Column, schema_json: str, mode: str = "PERMISSIVE") -> Column:
    """Binary Avro value -> struct (bad records -> null in PERMISSIVE mode)."""
    return _avro().from_avro(value, schema_json, {"mode": mode})


def encode_avro(struct_col: Column, schema_json: str | None = None) -> Column:
    """Struct -> binary Avro value."""
    A = _avro()
    return A.to_avro(struct_col, schema_json) if schema_json else A.to_avro(struct_col)
