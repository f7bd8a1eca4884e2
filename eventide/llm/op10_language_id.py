"""Language ID by conditional compression.

A text is compressed, block by block, with each language's zstandard
raw-content dictionary; the language whose dictionary makes all blocks together
smallest is chosen, and the relative margin to the second is the score.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventide.llm.common import spare_name

#: bound of the learning sample: rows of each language, and code points taken of each row
SAMPLE_ROWS = 120
SAMPLE_CHARS = 1500
#: compressor of the classifier: short matches count, as words are short
LEVEL, MIN_MATCH, STRATEGY = 3, 3, zstandard.STRATEGY_GREEDY
#: bytes compressed at once: a dictionary helps only what is near it, so each block meets it anew
BLOCK = 8192
#: a prediction with a smaller relative margin is a rejection
MIN_MARGIN = 0.002
UNKNOWN = "und"

_NOT_WORDS = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")


def held_out(doc_id):
    """crc32 of the id as text, mod 4, is 2; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def plain(text: str) -> bytes:
    """Lower-case words only: digits, marks and white space between them become one blank."""
    return _NOT_WORDS.sub(" ", text.lower()).strip().encode()


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS) -> dict[str, bytes]:
    """Dictionary content per language, from a bounded sample of rows that are not held out.

    Of each language at most ``sample_rows`` rows give text, those whose id's hash
    is smallest (each task sends no more), with ``sample_chars`` code points
    each.  Languages come in the order of their number of rows, over all rows
    that are not held out, then by name.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
                       & ~held_out(F.col("id"))).select("id", "lang", F.substring("text", 1, sample_chars).alias("text"))
    often = [r["lang"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()]
    order = W.partitionBy("lang").orderBy(F.xxhash64("id"), "id", "text")
    picked = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= sample_rows).collect()
    found: dict[str, list[tuple[int, bytes]]] = {}
    for r in picked:
        found.setdefault(r["lang"], []).append((r["n"], plain(r["text"])))
    return {lang: b" ".join(t for _, t in sorted(found[lang])) for lang in often}


class Classifier:
    """Chooses the language whose dictionary compresses a text best."""

    def __init__(self, content: dict[str, bytes]):
        self.langs = [lang for lang, c in content.items() if len(c) >= 8]  # shorter content is no dictionary
        params = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, min_match=MIN_MATCH, strategy=STRATEGY, write_content_size=0, write_dict_id=0, write_checksum=0)
        self.packers = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            self.packers.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params))

    def sizes(self, words: bytes) -> list[int]:
        """Compressed bytes of the whole text with each dictionary, summed over its blocks."""
        blocks = [words[at:at + BLOCK] for at in range(0, len(words), BLOCK)]
        return [sum(len(p.compress(b)) for b in blocks) for p in self.packers]

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, relative margin); ``und`` and 0 without letters or without learned languages."""
        if not text or not self.langs or not _LETTER.search(text):
            return UNKNOWN, 0.0
        sizes = self.sizes(plain(text))
        best = min(range(len(sizes)), key=lambda i: (sizes[i], i))
        rest = [s for i, s in enumerate(sizes) if i != best]
        return self.langs[best], 1.0 - sizes[best] / min(rest) if rest else 1.0


def _scores(content: dict[str, bytes]):
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Classifier(content)
        for texts in parts:
            yield pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score"])
    return run


def identify(docs: DataFrame, content: dict[str, bytes], text_col: str = "text", name: str = "lang_of_text") -> DataFrame:
    """``docs`` with a column ``name`` (lang_pred, score) made from the whole text alone."""
    scored = F.pandas_udf(_scores(content), "lang_pred string, score double")
    return docs.withColumn(name, scored(F.col(text_col)))


def predict_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                      min_margin: float = MIN_MARGIN) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, rejected.

    Learns from rows that are not held out and have a language; id, source and
    language are never inputs of a prediction.  ``rejected``: the score is under
    ``min_margin`` or the text has no letter.  Null and letterless texts are
    ``und`` with score 0; ties go to the language with most rows, with score 0;
    with one learned language every text with letters is that, score 1; with
    none all are ``und``.  Texts count whole, whatever their length: every block
    weighs alike, so a long text of one kind scores like a block of it; repeated
    rows are judged each; an empty table gives no rows.
    """
    content = learn(docs, id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return identify(rows, content).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_of_text.lang_pred", "lang_of_text.score",
        (~_told("lang_of_text", min_margin)).alias("rejected"))


def _told(name: str, min_margin: float):
    return (F.col(f"{name}.lang_pred") != UNKNOWN) & (F.col(f"{name}.score") >= min_margin)


def keep_identified(docs: DataFrame, min_margin: float = MIN_MARGIN) -> DataFrame:
    """``docs`` without the rows that the classifier rejects, all columns as they came."""
    name = spare_name(docs, "lang_of_text")
    return identify(docs, learn(docs), name=name).filter(_told(name, min_margin)).drop(name)
