"""Corpus pipeline over ``documents``: quality classifier, quality rules, n-gram Jaccard
join, mixing to target weights, packing. Every stage works on all rows that the stage
before kept; its output is written as Parquet and read again. All stages but the last
return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zoneflow.llm import line_quality, mixing, ngram_join, packing, quality_model
from zoneflow.llm.common import read, written


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, fitted on the labelled ones, predicts good."""
    return quality_model.keep_good(docs, quality_model.fit(docs, read(spark, sf_dir, "labels")))


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without their frequent lines."""
    return line_quality.keep_good(docs)


def join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return ngram_join.keep_one(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents by the mix's plan; the one at a source's cut ends there."""
    return mixing.mix(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Segments with bucket, batch and slot."""
    return packing.pack(docs)


STAGES = [("quality classifier", classifier_stage), ("quality rules", rules_stage), ("n-gram Jaccard join", join_stage),
          ("mixing", mix_stage), ("packing", pack_stage)]
# Models, shingle hashes and the packing program are not SQL: tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
