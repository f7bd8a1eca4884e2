"""E-1: reading rows of one declared schema as another, by Avro's resolution rules.

Writer and reader schemas are Avro schema texts.  ``resolve`` compiles a pair of
them into one Column, so an evolution is a projection that Catalyst sees
through.  Fields match by name or reader alias; a field the writer lacks takes
the reader's default; numbers widen, strings and bytes interchange; enums, arrays,
maps and nested records are resolved inside.  What no rule allows is an error
before any row is read.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Spark type of each Avro type, and of the logical types that are used here
_PLAIN = {"string": T.StringType(), "bytes": T.BinaryType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(),
          "double": T.DoubleType(), "boolean": T.BooleanType()}
_LOGICAL = {"timestamp-micros": T.TimestampType(), "local-timestamp-micros": T.TimestampNTZType(), "date": T.DateType()}
#: what a writer's type may be read as besides itself
_WIDER = {"int": {"long", "float", "double"}, "long": {"float", "double"}, "float": {"double"}, "string": {"bytes"}, "bytes": {"string"}}


class SchemaError(ValueError):
    """The reader's schema cannot read what the writer's declares."""


def parse(text: str) -> dict:
    """A schema text with its named types put in wherever they are referred to by name."""
    named: dict[str, dict] = {}

    def walk(s):
        if isinstance(s, list):
            return [walk(x) for x in s]
        if isinstance(s, str):
            if s in _PLAIN or s == "null":
                return {"type": s}
            if s not in named:
                raise SchemaError(f"type {s} is not declared")
            return named[s]
        kind = s["type"]
        if kind in ("record", "enum"):
            named[s["name"]] = out = dict(s)
            if kind == "record":
                out["fields"] = [{**f, "type": walk(f["type"])} for f in s["fields"]]
            return out
        if kind == "array":
            return {**s, "items": walk(s["items"])}
        if kind == "map":
            return {**s, "values": walk(s["values"])}
        return dict(s) if isinstance(kind, str) and (kind in _PLAIN or kind == "null") else walk(kind)
    return walk(json.loads(text))


def _branch(schema) -> tuple[dict, bool]:
    """(the type, whether it may be null): a union is null and one type."""
    if not isinstance(schema, list):
        return schema, False
    rest = [s for s in schema if s["type"] != "null"]
    if len(rest) != 1:
        raise SchemaError("a union has null and one other type")
    return rest[0], len(rest) < len(schema)


def spark_type(schema) -> T.DataType:
    """The Spark type of a parsed schema."""
    s, _ = _branch(schema)
    kind, logical = s["type"], s.get("logicalType")
    if logical == "decimal":
        return T.DecimalType(s["precision"], s.get("scale", 0))
    if logical in _LOGICAL:
        return _LOGICAL[logical]
    if kind == "record":
        return T.StructType([T.StructField(f["name"], spark_type(f["type"])) for f in s["fields"]])
    if kind == "array":
        return T.ArrayType(spark_type(s["items"]))
    if kind == "map":
        return T.MapType(T.StringType(), spark_type(s["values"]))
    return T.StringType() if kind == "enum" else _PLAIN[kind]


def _default(value, schema) -> Column:
    """A field's default as a Column of the field's type."""
    return F.lit(None).cast(spark_type(schema)) if value is None else F.from_json(
        F.lit(json.dumps({"v": value})), T.StructType([T.StructField("v", spark_type(schema))]))["v"]


def resolve(writer, reader, value: Column, path: str = "") -> Column:
    """``value``, of the writer's type, as the reader's; both are parsed schemas."""
    w, w_null = _branch(writer)
    r, r_null = _branch(reader)
    out = _resolve(w, r, value, path)
    if w_null and not r_null:  # seen when a row is read, as the rules have it
        out = F.coalesce(out, F.raise_error(F.lit(f"null in {path or 'a record'}, which the reader says is never null")).cast(spark_type(r)))
    return out


def _resolve(w: dict, r: dict, value: Column, path: str) -> Column:
    kind = r["type"]
    if kind in ("record", "array", "map", "enum"):
        if w["type"] != kind:
            raise SchemaError(f"{path or 'the schema'}: {w['type']} cannot be read as {kind}")
        return {"record": _record, "array": _array, "map": _map, "enum": _enum}[kind](w, r, value, path)
    if w.get("logicalType") != r.get("logicalType") or (w.get("precision"), w.get("scale", 0)) != (r.get("precision"), r.get("scale", 0)):
        raise SchemaError(f"{path}: logical type {w.get('logicalType')} cannot be read as {r.get('logicalType')}")
    if w["type"] != kind and kind not in _WIDER.get(w["type"], ()):
        raise SchemaError(f"{path}: {w['type']} cannot be read as {kind}")
    return value if w["type"] == kind else value.cast(spark_type(r))


def _fields(w: dict, r: dict, value_of, path: str) -> list[Column]:
    """The reader's fields; ``value_of`` gives the writer's by name."""
    known, out = {f["name"]: f for f in w["fields"]}, []
    for f in r["fields"]:
        at = f"{path}.{f['name']}" if path else f["name"]
        name = next((n for n in (f["name"], *f.get("aliases", ())) if n in known), None)
        if name is not None:
            got = resolve(known[name]["type"], f["type"], value_of(name), at)
        elif "default" in f:
            got = _default(f["default"], f["type"])
        else:
            raise SchemaError(f"{at}: the writer has no such field, the reader no default")
        out.append(got.alias(f["name"]))
    return out


def _record(w: dict, r: dict, value: Column, path: str) -> Column:
    return F.when(value.isNotNull(), F.struct(*_fields(w, r, lambda name: value[name], path)))


def _array(w: dict, r: dict, value: Column, path: str) -> Column:
    return F.transform(value, lambda x: resolve(w["items"], r["items"], x, f"{path}[]"))


def _map(w: dict, r: dict, value: Column, path: str) -> Column:
    return F.transform_values(value, lambda _, x: resolve(w["values"], r["values"], x, f"{path}{{}}"))


def _enum(w: dict, r: dict, value: Column, path: str) -> Column:
    strange = [s for s in w["symbols"] if s not in r["symbols"]]
    if not strange:
        return value
    if "default" in r:
        return F.when(value.isin(strange), F.lit(r["default"])).otherwise(value)
    return F.when(value.isin(strange), F.raise_error(F.concat(F.lit(f"{path}: no symbol "), value)).cast("string")).otherwise(value)


def read_as(df: DataFrame, writer: str, reader: str) -> DataFrame:
    """Rows of the writer's schema (a text) with the columns of the reader's, which Catalyst can prune one by one."""
    return df.select(*_fields(parse(writer), parse(reader), F.col, ""))


def declare(struct: T.StructType, name: str, defaults: dict | None = None) -> str:
    """The schema text of a Spark struct.

    Fields may be null, those in ``defaults`` have a default: null, or a value
    that makes them never null.
    """
    plain = {type(v): k for k, v in _PLAIN.items()}
    logical = {type(v): k for k, v in _LOGICAL.items()}
    count = iter(range(10**6))

    def of(t: T.DataType):
        if isinstance(t, T.DecimalType):
            return {"type": "bytes", "logicalType": "decimal", "precision": t.precision, "scale": t.scale}
        if type(t) in logical:
            return {"type": "int" if isinstance(t, T.DateType) else "long", "logicalType": logical[type(t)]}
        if isinstance(t, T.StructType):
            return {"type": "record", "name": f"{name}_{next(count)}", "fields": [{"name": f.name, "type": ["null", of(f.dataType)]} for f in t]}
        if isinstance(t, T.ArrayType):
            return {"type": "array", "items": ["null", of(t.elementType)]}
        if isinstance(t, T.MapType):
            return {"type": "map", "values": ["null", of(t.valueType)]}
        return plain[type(t)]
    given = defaults or {}
    fields = []
    for f in struct.fields:
        own = {"name": f.name, "type": ["null", of(f.dataType)]}
        if f.name in given:
            own["default"] = given[f.name]
            own["type"] = own["type"] if given[f.name] is None else own["type"][1]
        fields.append(own)
    return json.dumps({"type": "record", "name": name, "fields": fields})
