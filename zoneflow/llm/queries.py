"""Registered queries of the corpus operators (whole tables, production parameters) and
their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zoneflow.llm import (html_extract, language_id, lexical_search, line_quality, mixing, ngram_join, packing, quality_model, topk_search, toxicity,
                         url_filter, warc, whitening)
from zoneflow.llm.common import read
from zoneflow.llm.oracle import ORACLE  # noqa: F401  (for __spark_entry__)

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's segments with bucket, batch and slot."""
    return packing.pack(read(spark, sf_dir, "documents"))


@query
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, winning rule and verdict."""
    return url_filter.filter_urls(read(spark, sf_dir, "pages"))


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's share of the mix of all sources."""
    return mixing.mix_plan(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


@query
def op10_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base statistics and verdict."""
    out = line_quality.judge(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words")

@query
def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors for every vector whose id is divisible by 50."""
    vectors = read(spark, sf_dir, "embeddings")
    return topk_search.search(vectors, vectors.where("vec_id % 50 = 0"))


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score by the rule ensemble."""
    docs = read(spark, sf_dir, "documents")
    return quality_model.score(docs, quality_model.fit(docs, read(spark, sf_dir, "labels")))


@query
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language by the word-level random field."""
    docs = read(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.fit(docs))


@query
def op4_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return html_extract.extract(read(spark, sf_dir, "pages"))


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through legacy archives, the converter and WARC archives."""
    return warc.archive_pages(read(spark, sf_dir, "pages")).drop("record_id")


@query
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate class."""
    return ngram_join.classes(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity by the span tagger, with the places of its spans."""
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the first four whitening components."""
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


@query
def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents for every benchmark item."""
    return lexical_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
