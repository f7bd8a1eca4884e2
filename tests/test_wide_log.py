"""The order log's offsets are given in chunks of bounded rows; exactly-once runs take a larger log in as many micro-batches."""
import os

from eventide.functions import scan
from eventide.plans import queries as Q
from eventide.sources import views as V

SF = "/root/testdata/sf0.001"


def test_offsets_of_wide_rows_are_the_same_in_chunks(spark, monkeypatch):
    whole = {tuple(r) for r in V.orders_log(spark, SF).collect()}
    cut = []
    real = scan.split_hot
    monkeypatch.setattr(scan, "split_hot", lambda *a: cut.append(real(*a)) or cut[-1])
    monkeypatch.setattr(V, "WIDE_CHUNK_ROWS", 40)
    chunked = V.orders_log(spark, SF)
    rows, split = chunked.collect(), cut[0][1]
    assert len(rows) == len(whole) and {tuple(r) for r in rows} == whole
    assert split is not None and split.groupBy(scan.CHUNK).count().agg({"count": "max"}).first()[0] <= 80  # sampled bounds


def test_wide_rows_are_cut_well_below_narrow_ones():
    assert V.WIDE_CHUNK_ROWS * 4 < scan.DEFAULT_MAX_CHUNK_ROWS


def test_a_log_of_many_files_takes_few_micro_batches(spark, monkeypatch):
    outs, stage = [], Q._stage
    monkeypatch.setattr(Q, "_stage", lambda df, sp, name: stage(df.repartition(40), sp, name))
    path = Q.scratch_path
    monkeypatch.setattr(Q, "scratch_path", lambda sp, name: outs.append(path(sp, name)) or outs[-1])
    got = Q.q_exactly_once_pipeline(spark, SF)
    out = next(o for o in outs if "eos-out" in o)
    batches = [f for f in os.listdir(f"{out}/_spark_metadata") if not f.startswith(".")]
    assert 1 < len(batches) <= Q.EOS_BATCHES and got.count() == got.select("order_id").distinct().count() > 1000
