"""File sinks: upserts as deltas (last write wins, deletes, replays), archive days."""
from pyspark.sql import functions as F

from eventide.session import scratch_path
from eventide.sinks import files as K


def _rows(spark, rows):
    return spark.createDataFrame(rows, "k string, v long, t long, op string")





def _table(spark, path, **kw):
    return {r.k: r.v for r in K.read_upserted(spark, path, ["k"], ["t"], F.col("op") == "d", **kw).collect()}


def test_upsert_deletes_and_replay(spark):
    path = scratch_path(spark, "ups-test")
    K.upsert(_rows(spark, [(f"k{i}", i, 0, "u") for i in range(40)]), path, version=0)
    b1 = _rows(spark, [("k1", 100, 1, "u"), ("k1", 101, 2, "u"), ("k2", 0, 1, "d"), ("new", 7, 1, "u")])
    K.upsert(b1, path, version=1)
    K.upsert(b1, path, version=1)  # replay
    got = _table(spark, path)
    assert got["k1"] == 101 and "k2" not in got and got["new"] == 7 and len(got) == 40
    assert len(_table(spark, path, until=0)) == 40  # as of the first delta
    assert spark.read.parquet(path).count() == 44  # a delta holds its batch alone


def test_the_latest_row_wins_whatever_the_batches(spark):
    path = scratch_path(spark, "ups-order")
    K.upsert(_rows(spark, [("a", 10, 10, "u"), ("gone", 1, 10, "d")]), path, version=0)
    K.upsert(_rows(spark, [("a", 3, 3, "u"), ("gone", 2, 3, "u")]), path, version=1)
    assert _table(spark, path) == {"a": 10}  # an older row does not bring a deleted key back
    K.upsert(_rows(spark, [("a", 11, 10, "u")]), path, version=2)
    assert _table(spark, path) == {"a": 11}  # of equal ones the later delta


def test_merged_deltas_give_the_same_table(spark):
    path, merged = scratch_path(spark, "ups-many"), scratch_path(spark, "ups-merged")
    for n in range(5):
        K.upsert(_rows(spark, [(f"k{i}", 10 * n + i, n, "d" if i == n else "u") for i in range(n, 8)]), path, version=n)
    K.merge_deltas(spark, path, merged, ["k"], ["t"])
    assert _table(spark, merged) == _table(spark, path)
    assert spark.read.parquet(merged).count() == 8  # one row per key, deletes among them
    for p in (path, merged):
        K.upsert(_rows(spark, [("k0", 1, -1, "u"), ("k4", 9, 9, "u")]), p, version=7)
    assert _table(spark, merged) == _table(spark, path) and _table(spark, path)["k4"] == 9 and "k0" not in _table(spark, path)


def test_archive_day_bounds(spark):
    path = scratch_path(spark, "arch-days")
    df = spark.sql("select id, timestamp_ntz'2024-01-03 12:00:00' + make_dt_interval(id) as t from range(12)")
    K.write_archive(df, path, "t")
    days = lambda *b: sorted(r.id for r in K.read_archive(spark, path, *b).collect())
    assert days() == list(range(12)) and days("2024-01-05") == list(range(2, 12))
    assert days(None, "2024-01-05") == [0, 1, 2] and days("2024-01-09", "2024-01-12") == [6, 7, 8, 9]


def test_fan_out_reports_what_a_sink_holds(spark):
    base = scratch_path(spark, "fan")

    def loses_rows(df):
        df.filter("id % 2 = 0").write.parquet(f"{base}/half")
        return spark.read.parquet(f"{base}/half")

    def keeps(df):
        df.write.parquet(f"{base}/all")
        return spark.read.parquet(f"{base}/all")
    assert K.fan_out(spark.range(10), {"half": loses_rows, "all": keeps}) == {"half": 5, "all": 10}
