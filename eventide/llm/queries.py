"""The registered queries of the training-data operators: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import op1_sentencepiece as op1
from eventide.llm import op2_license_scan as op2
from eventide.llm import op3_html_text as op3
from eventide.llm import op4_embedding_dedup as op4
from eventide.llm import op5_warc as op5
from eventide.llm import op6_packing as op6
from eventide.llm import op7_exact_dedup as op7
from eventide.llm import op8_minhash_dedup as op8
from eventide.llm import op9_url_filter as op9
from eventide.llm import op10_language_id as op10
from eventide.llm import op11_merkle_manifest as op11
from eventide.llm import op12_line_dedup as op12
from eventide.llm import op13_lexical_search as op13
from eventide.llm.common import table, vocabulary

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


@query("op1_sentencepiece")
def q_sentencepiece(spark, sf):
    return op1.sample_segmentations(table(spark, sf, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op2_license_scan")
def q_license_scan(spark, sf):
    return op2.scan_licenses(table(spark, sf, "documents"))


@query("op3_html_text")
def q_html_text(spark, sf):
    return op3.main_text(table(spark, sf, "pages"))


@query("op4_embedding_dedup")
def q_embedding_dedup(spark, sf):
    return op4.near_vectors(table(spark, sf, "embeddings"))


@query("op5_warc")
def q_warc(spark, sf):
    return op5.round_trip(table(spark, sf, "pages"))


@query("op6_packing")
def q_packing(spark, sf):
    return op6.pack_documents(table(spark, sf, "documents"), vocabulary("word_bpe_49k.json"))


@query("op7_exact_dedup")
def q_exact_dedup(spark, sf):
    return op7.exact_duplicates(table(spark, sf, "documents"))


@query("op8_minhash_dedup")
def q_minhash_dedup(spark, sf):
    return op8.near_duplicates(table(spark, sf, "documents"), width=4)


@query("op9_url_filter")
def q_url_filter(spark, sf):
    return op9.judge_urls(table(spark, sf, "pages"), op9.rules_table(spark))


@query("op10_language_id")
def q_language_id(spark, sf):
    return op10.predict_languages(table(spark, sf, "documents"))


@query("op11_merkle_manifest")
def q_merkle_manifest(spark, sf):
    return op11.manifest(table(spark, sf, "documents")).drop("proof")


@query("op12_line_dedup")
def q_line_dedup(spark, sf):
    return op12.dedup_lines(table(spark, sf, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op13_lexical_search")
def q_lexical_search(spark, sf):
    return op13.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("pipeline")
def q_pipeline(spark, sf):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf)
