"""Row keys: one per row, the same however the rows are read."""
from pyspark.sql import functions as F

from eventide.llm import op3_html_text as op3
from eventide.llm import op5_warc as op5
from eventide.llm.common import with_row_key

PAGES = "/root/testdata/sf0.001/pages.parquet"


def keys(df):
    return sorted(tuple(r) for r in with_row_key(df, "key").select("page_id", "key").collect())


def test_same_under_other_splits(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.read.parquet(PAGES).repartition(3).write.option("parquet.block.size", 65536).parquet(path)
    pages = spark.read.parquet(path).select("page_id", "html")
    assert "_metadata" not in pages.columns
    had, most, parts = keys(pages), spark.conf.get("spark.sql.files.maxPartitionBytes"), pages.rdd.getNumPartitions()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    try:
        again = keys(spark.read.parquet(path).select("page_id", "html"))
        assert spark.read.parquet(path).rdd.getNumPartitions() != parts  # read in other pieces
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
    assert had == again and len({k for _, k in had}) == len(had) == pages.count()
    assert all(k.startswith("file:") and "/rows-" not in k for _, k in had)  # the scan itself, no copy


def test_frames_that_are_no_scan(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "page_id long, html string")
    got = with_row_key(df, "key").collect()
    assert len({r.key for r in got}) == 3
    assert sorted(map(repr, [(r.page_id, r.html) for r in got])) == sorted(map(repr, [(1, "a"), (1, "a"), (None, None)]))


def test_splits_that_change_between_the_reads(spark, monkeypatch):
    """Executors come and go between two reads of the table: no page loses another's subtrees, no record gets another's chunks."""
    pages = spark.read.parquet(PAGES).repartition(1)
    path = spark.conf.get("spark.checkpoint.dir") + "/pages-one-file"
    pages.write.mode("overwrite").option("parquet.block.size", 65536).parquet(path)
    read = lambda: spark.read.parquet(path)
    most, want3, want5 = spark.conf.get("spark.sql.files.maxPartitionBytes"), op3.main_text(read()).collect(), op5.round_trip(read()).collect()

    def changing(df, name, real={"op3": op3.stage_table, "op5": op5.stage_table}):
        out = real["op3"](df, name)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")  # the next read is split otherwise
        return out
    for module, run, want in ((op3, op3.main_text, want3), (op5, op5.round_trip, want5)):
        monkeypatch.setattr(module, "stage_table", changing)
        try:
            assert sorted(run(read()).collect()) == sorted(want)
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", most)


def test_recurring_menus_footers_and_adverts_come_out_of_the_count(spark):
    """Of the given pages: every subtree that names itself and stands on three pages of a host is found by counting."""
    from collections import defaultdict
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    keyed = with_row_key(pages, "rid").select("rid", op3._host(F.col("url")).alias("host"), "html")
    held = defaultdict(lambda: defaultdict(set))
    for r in keyed.collect():
        page = op3.Page(r.html or "", decode=False)
        text = "\n".join(b[0] for b in page.said())
        for h, kind in page.subtrees().items():
            if kind & op3._NAMED_SO:
                held[r.host][h].add(text)
    want = {(host, op3._signed(h)) for host, by in held.items() for h, texts in by.items() if len(texts) >= op3.FEW_PAGES}
    cut = op3.templates(keyed).join(keyed.select("rid", "host"), "rid").select("host", F.explode("cut").alias("h")).distinct()
    got = {tuple(r) for r in cut.collect()}
    assert want <= got and len(want) > 0
