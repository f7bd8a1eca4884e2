"""Corpus pipeline: language ID, exact dedup, near-dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``.  All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventide.llm import op6_packing, op7_exact_dedup, op8_minhash_dedup, op10_language_id
from eventide.llm.common import stage_table, table, vocabulary


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier tells; those it rejects go.

    Null, empty and letterless texts are rejected; rows without id or language
    are judged like others and teach nothing; repeated rows are judged each; a
    tie of two languages has no margin and is rejected; an empty table stays
    empty; further columns, whatever their names, come along.
    """
    return op10_language_id.keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest as written, then the smallest id.

    Null and empty texts and those of white space alone are one group; a row
    without id goes before none with one; of repeated rows one stays; an empty
    table stays empty; further columns, whatever their names, come along.
    """
    return op7_exact_dedup.drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8 or more): the smallest id.

    Texts without words and rows without id link with nothing and stay; rows
    that share an id stay or go together, repeated ones too; an empty table stays
    empty; further columns, whatever their names, come along.
    """
    return op8_minhash_dedup.drop_near_duplicates(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences: one row per piece of a document.

    Null and empty texts are the end mark alone; rows without id and repeated
    rows are documents of their own; longer documents than a sequence are cut;
    an empty table gives no rows; further columns are not read.
    """
    return op6_packing.pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("packing", packing)]

#: SQL has no zstandard compressor and no tokenizer; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one keeps is written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage_table(docs, f"pipeline-{name}")
    return docs
