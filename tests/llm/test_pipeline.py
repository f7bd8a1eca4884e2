"""The pipeline: each stage against brute force on its own input, and the whole run."""
import re

import corpus_pipeline
from eventide.llm import op10_language_id as op10
from eventide.llm.common import stage_table

from test_minhash_dedup import brute as near_brute

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, docs
    model = op10.Classifier(op10.learn(docs))
    before = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        kept = stage_table(stage(spark, kept, SF), "t")
        rows = kept.collect()
        if name == "language_id":
            scores = {r.doc_id: model.predict(r.text) for r in before}
            want = {i for i, (lang, score) in scores.items() if lang != "und" and score >= op10.MIN_MARGIN}
            assert len(want) >= 0.97 * len(before)
        elif name == "exact_dedup":
            best = {}
            for r in before:
                text = re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
                best[text] = min(best.get(text, (1, 0)), (-len(r.text or ""), r.doc_id))
            want = {i for _, i in best.values()}
        elif name == "near_dedup":
            want = {x[0] for x in near_brute([(r.doc_id, r.text) for r in before], 5) if x[3]}
        else:
            assert {r.doc_id for r in rows} == {r.doc_id for r in before}
            assert all(r.offset + r.length <= 4096 for r in rows)
            break
        assert kept.columns == columns
        assert sorted(r.doc_id for r in rows) == sorted(want)
        same = {r.doc_id: r for r in before}
        assert all(same[r.doc_id] == r for r in rows)  # rows come as they were
        before = rows
    ran = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in ran.collect()) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in rows)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "packing"]


CLASH = ["lang_of_text", "__lang", "op7_key", "op7_place", "__op7_key", "__op7_n", "op8_id", "__op8_id", "rid", "name", "level", "kept", "node"]


def odd(spark, rows):
    """Rows (doc_id, text, lang), with further columns that have the names stages might use."""
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    return docs.selectExpr("*", *[f"'{c}' AS `{c}`" for c in CLASH])


WORDS = "the quick brown fox jumps over the lazy dog while seven wizards hold a boxing match near quiet harbour lights"


def test_odd_rows_in_every_stage(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing names: each has its defined result."""
    text = lambda k: " ".join(f"{w}{k}" for w in WORDS.split())
    rows = [(1, text(1), "en"), (1, text(1), "en"), (2, text(1) + " ", None), (3, None, None), (4, "", "en"), (5, " \n", None),
            (None, text(2), "en"), (None, text(2), "en"), (7, text(3), "de"), (8, text(3) + " end", "de"), (9, "12 34 !", "en"),
            (10, (text(4) + " ") * 3000, "en"), (11, "one", "en")]
    docs = odd(spark, rows)
    kept = lambda stage, d: sorted(((r.doc_id, r.text) for r in stage(spark, d, SF).collect()), key=repr)
    told = kept(corpus_pipeline.language_id, docs)
    assert all(t and any(c.isalpha() for c in t) for _, t in told)
    exact = kept(corpus_pipeline.exact_dedup, docs)
    assert exact == sorted([(2, text(1) + " "), (5, " \n"), (None, text(2)), (7, text(3)), (8, text(3) + " end"), (9, "12 34 !"),
                            (10, (text(4) + " ") * 3000), (11, "one")], key=repr)
    near = kept(corpus_pipeline.near_dedup, docs)
    gone = [(2, text(1) + " "), (8, text(3) + " end")]  # of each group the smallest id stays, with its repeated rows
    assert near == sorted([(i, t) for i, t, _ in rows if (i, t) not in gone], key=repr)
    pieces = corpus_pipeline.packing(spark, docs, SF).collect()
    assert len({(r.sequence_id, r.offset) for r in pieces}) == len(pieces) and sum(r.piece == 0 for r in pieces) == len(rows)
    for stage in (corpus_pipeline.language_id, corpus_pipeline.exact_dedup, corpus_pipeline.near_dedup):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and all(r[c] == c for r in out.select(*CLASH).collect() for c in CLASH)


def test_empty_table_in_every_stage(spark):
    docs = odd(spark, [(1, "x", "en")]).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []
