"""Language ID: accuracy on held-out rows, and what it does without letters or without labels."""
import zlib

from eventide.llm import op10_language_id as op10

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    told = {r.doc_id: r for r in op10.predict_languages(docs).collect()}
    rows = docs.select("doc_id", "lang").collect()
    assert len(told) == len(rows)
    out = [r for r in rows if told[r.doc_id].held_out]
    assert {r.doc_id for r in out} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    right = sum(told[r.doc_id].lang_pred == r.lang for r in out)
    assert right >= 0.98 * len(out)
    assert all(0 <= t.score <= 1 for t in told.values())
    assert sum(t.rejected for t in told.values()) <= 0.03 * len(told)


def test_the_label_is_no_input(spark):
    """Held-out rows are predicted alike whatever label they carry."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    swapped = docs.selectExpr("doc_id", "text", "if(pmod(crc32(cast(doc_id as string)), 4) = 2, 'xx', lang) lang", "'s' source", "n_chars")
    one = {r.doc_id: r for r in op10.predict_languages(docs).collect()}
    two = {r.doc_id: r for r in op10.predict_languages(swapped).collect()}
    assert all(one[k] == two[k] for k in one)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, x, "s", 0.5, "p") for i, t, x in rows],
                                 "doc_id long, text string, lang string, source string, score double, lang_pred string")


def test_edges(spark):
    english = " ".join(f"the cat number {w} sat on that mat with the other cats" for w in "one two three four five six".split())
    german = " ".join(f"die Katze {w} sitzt auf der Matte und nicht unter dem Tisch" for w in "eins zwei drei vier".split())
    rows = [(i, english, "en") for i in range(8)] + [(i, german, "de") for i in range(8, 16)]
    rows += [(100, None, "en"), (101, "", None), (102, "123 !!", "en"), (103, german * 500, None), (None, english, None), (None, english, "xx"),
             (104, "the cat sat on that mat", None), (104, "the cat sat on that mat", None)]
    got = op10.predict_languages(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert all(by[k][0].lang_pred == "und" and by[k][0].score == 0 and by[k][0].rejected for k in (100, 101, 102))
    assert by[103][0].lang_pred == "de" and by[104][0].lang_pred == by[104][1].lang_pred == "en"
    assert all(r.lang_pred == "en" and not r.held_out for r in by[None])  # a row without id teaches nothing
    kept = op10.keep_identified(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert {r.doc_id for r in kept.collect()} == set(by) - {100, 101, 102}


def test_nothing_learned_and_empty_table(spark):
    got = op10.predict_languages(frame(spark, [(1, "some text", None)])).collect()
    assert got[0].lang_pred == "und" and got[0].score == 0
    assert op10.predict_languages(frame(spark, [])).collect() == []


def test_ties_go_to_the_language_with_most_rows(spark):
    model = op10.Classifier({"b": b"some learned words", "a": b"some learned words"})
    assert model.predict("some learned words") == ("b", 0.0)


def test_score_and_choice_do_not_depend_on_length(spark):
    """5 MB of one language are scored like 8 kB of it, and what is behind the first part counts as much."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = op10.Classifier(op10.learn(docs))
    given = {}
    for r in docs.filter(op10.held_out(docs.doc_id)).orderBy("doc_id").collect():
        given.setdefault(r.lang, []).append(r.text or "")
    long = {lang: (" ".join(given[lang]) + " ") * (5_000_000 // sum(map(len, given[lang])) + 1) for lang in ("en", "fr", "de")}
    for lang, text in long.items():
        assert len(text) >= 5_000_000
        told, score = model.predict(text)
        short = [model.predict(text[at:at + 8000]) for at in range(0, 80_000, 8000)]
        assert told == lang and score >= op10.MIN_MARGIN
        assert 0.5 * min(s for _, s in short) <= score <= 2 * max(s for _, s in short)
    assert model.predict(long["en"][:1_000_000] + long["fr"][:3_000_000])[0] == "fr"
    assert model.predict(long["fr"][:1_000_000] + long["en"][:3_000_000])[0] == "en"
