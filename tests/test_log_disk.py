"""The order log of many rows is laid out by its numbers, made in slices, and its scratch tables go when they are read."""
import collections
import datetime as dt
import os

from eventide import session
from eventide.functions import scan
from eventide.plans import queries as Q
from eventide.sources import views as V


def tables(spark, folder):
    """Orders of which some come twice, have no key, no time or no lines; lines without order, part or number."""
    day = dt.datetime(1996, 1, 1)
    orders = [(k, k % 37, 100.5 * k, day + dt.timedelta(days=k // 3)) for k in range(1, 400)] + [(7, 7, 1.0, day), (7, 8, 2.0, None), (None, 5, 9.0, day)]
    lines = [(k, k * 7 % 50, n, float(n + 1), 10.0 * k) for k in range(1, 380) for n in range(k % 4)]
    lines += [(9, 3, 0, 1.0, 5.0), (9, 3, 0, 1.0, 5.0), (9, None, None, 2.0, 7.0), (None, 3, 1, 1.0, 5.0), (9999, 3, 1, 1.0, 5.0), (11, 999, 1, None, None)]
    parts = [(p, f"part {p}") for p in range(45)] + [(44, "again")]
    for name, rows, schema in (
            ("orders", orders, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz"),
            ("lineitem", lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double"),
            ("part", parts, "p_partkey long, p_name string")):
        spark.createDataFrame(rows, schema).repartition(2).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def rows(df):
    return collections.Counter(map(str, df.collect()))


def test_a_large_log_has_the_rows_of_a_small_one_and_lays_out_no_json(spark, tmp_path, monkeypatch):
    sf, laid = tables(spark, tmp_path), []
    small = rows(V.orders_log(spark, sf))
    real = scan.split_hot
    monkeypatch.setattr(scan, "split_hot", lambda df, *a: laid.append(df.columns) or real(df, *a))
    monkeypatch.setattr(V, "WIDE_CHUNK_ROWS", 20)
    monkeypatch.setattr(V, "PLAIN_LOG_ROWS", 20, raising=False)
    large = rows(V.orders_log(spark, sf))
    assert len(laid) == 1 and not {"value", "items"} & set(laid[0])
    assert large == small and sum(small.values()) == 402
    slices = [rows(s) for s in V.orders_log_slices(spark, sf, 100)]
    assert len(slices) == 5 and all(slices) and sum(slices, collections.Counter()) == small


def test_exactly_once_runs_leave_only_their_output(spark, tmp_path, monkeypatch):
    sf = tables(spark, tmp_path)
    whole = rows(Q.q_eos_transform(spark, sf))
    monkeypatch.setattr(V, "PLAIN_LOG_ROWS", 20, raising=False)
    monkeypatch.setattr(V, "WIDE_CHUNK_ROWS", 20)
    monkeypatch.setattr(Q, "EOS_SLICE", 100, raising=False)
    base = session.ensure_checkpoint_dir(spark).removeprefix("file://")
    before, codec = set(os.listdir(base)), spark.conf.get("spark.sql.parquet.compression.codec")
    for q in (Q.q_exactly_once_pipeline, Q.q_read_committed):
        assert rows(q(spark, sf)) == whole
    left = {f.rsplit("-", 1)[0] for f in set(os.listdir(base)) - before}
    assert "eos-out" in left and not left & {"eos-src", "routed", "numbered", "scan-chunks"}
    assert spark.conf.get("spark.sql.parquet.compression.codec") == codec


def test_only_scratch_folders_are_dropped(spark, tmp_path):
    inside, outside = session.scratch_path(spark, "some"), f"{tmp_path}/some-0123456789ab"
    named = f"{session.ensure_checkpoint_dir(spark).rstrip('/')}/kept-table"
    for path in (inside, outside, named):
        spark.range(3).write.mode("overwrite").parquet(path)
    session.drop_scratch(*[spark.read.parquet(p) for p in (inside, outside, named)])
    assert [os.path.exists(p.removeprefix("file://")) for p in (inside, outside, named)] == [False, True, True]
