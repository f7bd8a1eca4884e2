"""Schema resolution: what each rule gives, and what it refuses before any row is read."""
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from eventide import schemas as S
from eventide.functions import schema_resolution as R


def record(*fields, name="r"):
    return json.dumps({"type": "record", "name": name, "fields": [dict(f) for f in fields]})


def f(name, kind, **more):
    return {"name": name, "type": kind, **more}


def test_numbers_widen_and_names_match_by_alias(spark):
    w = record(f("a", "int"), f("b", "long"), f("c", "float"), f("s", "string"), f("old", "string"))
    r = record(f("new", "string", aliases=["older", "old"]), f("a", "long"), f("b", "double"), f("c", "double"), f("s", "bytes"))
    df = spark.sql("select 7 a, 8L b, cast(0.5 as float) c, 'x' s, 'o' old")
    got = R.read_as(df, w, r)
    assert got.dtypes == [("new", "string"), ("a", "bigint"), ("b", "double"), ("c", "double"), ("s", "binary")]
    assert tuple(got.first()) == ("o", 7, 8.0, 0.5, bytearray(b"x"))


def test_missing_fields_take_defaults_of_any_type(spark):
    item = {"type": "record", "name": "i", "fields": [f("k", "string"), f("n", ["null", "int"], default=None)]}
    r = record(f("a", "int"), f("s", "string", default="é\"x"), f("l", {"type": "array", "items": "long"}, default=[1, 2]),
               f("m", {"type": "map", "values": "string"}, default={"k": "v"}), f("o", ["null", "string"], default=None),
               f("i", item, default={"k": "z", "n": 3}), f("j", ["null", "i"], default=None))
    got = R.read_as(spark.sql("select 1 a"), record(f("a", "int")), r).first()
    assert got.s == 'é"x' and got.l == [1, 2] and got.m == {"k": "v"} and got.o is None and tuple(got.i) == ("z", 3) and got.j is None


def test_nested_records_arrays_maps_and_enums(spark):
    inner = lambda *fields: {"type": "record", "name": "in", "fields": list(fields)}
    enum = lambda *s, **kw: {"type": "enum", "name": "e", "symbols": list(s), **kw}
    w = record(f("xs", {"type": "array", "items": ["null", inner(f("q", "int"), f("gone", "string"))]}),
               f("m", {"type": "map", "values": "int"}), f("e", enum("a", "b", "c")))
    r = record(f("m", {"type": "map", "values": "double"}), f("e", enum("a", "other", default="other")),
               f("xs", {"type": "array", "items": ["null", inner(f("p", "string", default="d"), f("q", "long"))]}))
    df = spark.sql("select array(named_struct('q', 1, 'gone', 'g'), null) xs, map('k', 2) m, e from values ('a'), ('b'), (null) t(e)")
    rows = R.read_as(df, w.replace('"e", "type": {', '"e", "type": {'), r).collect()
    assert [x.e for x in rows] == ["a", "other", None]
    assert rows[0].m == {"k": 2.0} and tuple(rows[0].xs[0]) == ("d", 1) and rows[0].xs[1] is None


@pytest.mark.parametrize("w, r, says", [
    (record(f("a", "long")), record(f("a", "int")), "long cannot be read as int"),
    (record(f("a", "string")), record(f("b", "string")), "no such field"),
    (record(f("a", {"type": "array", "items": "int"})), record(f("a", "int")), "array cannot be read as int"),
    (record(f("a", {"type": "bytes", "logicalType": "decimal", "precision": 12, "scale": 2})),
     record(f("a", {"type": "bytes", "logicalType": "decimal", "precision": 10, "scale": 2})), "logical type"),
    (record(f("a", ["int", "string"])), record(f("a", "int")), "union"),
    (record(f("a", "nowhere")), record(f("a", "int")), "not declared")])
def test_refused_before_any_row(spark, w, r, says):
    with pytest.raises(R.SchemaError, match=says):
        R.read_as(spark.sql("select 1 a"), w, r)


def test_null_where_the_reader_has_none_is_an_error_of_that_row(spark):
    w, r = record(f("a", ["null", "int"])), record(f("a", "int"))
    assert R.read_as(spark.sql("select 1 a"), w, r).first().a == 1
    with pytest.raises(PySparkException, match="never null"):
        R.read_as(spark.sql("select cast(null as int) a"), w, r).collect()


def test_declared_orders_read_both_ways_with_items(spark):
    """v1 and v2 on all fields: items stay as they are, v2's further fields come and go."""
    item = "named_struct('product_id', 'p', 'product_name', cast(null as string), 'quantity', 2, 'unit_price', cast(1.5 as decimal(12,2)))"
    v1 = spark.sql(f"select 'o' order_id, 'c' customer_id, array({item}) items, cast(3 as decimal(12,2)) total_amount, 'USD' currency, "
                   "'paypal' payment_method, 'a' shipping_address, 'apac' region, timestamp_ntz'2024-01-01 00:00:00.000001' placed_at")
    w, r = R.declare(S.ORDER_PLACED_V1, "o"), R.declare(S.ORDER_PLACED_V2, "o", S.ORDER_V2_DEFAULTS)
    up = R.read_as(v1, w, r)
    assert up.columns == S.ORDER_V2_FIELDS and up.drop("coupon_code", "priority", "metadata").first() == v1.first()
    assert (up.first().coupon_code, up.first().priority, up.first().metadata) == (None, "standard", {})
    down = R.read_as(up.withColumn("priority", F.lit("high")), r, w)
    assert down.collect() == v1.collect() and down.schema.simpleString() == v1.schema.simpleString()
