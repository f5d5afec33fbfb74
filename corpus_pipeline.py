"""A training corpus from documents: five stages, each written as Parquet and read again by the next.

Defined for every stage: a null text counts as empty; rows that repeat share a fate (near_duplicates keeps one of
an id); a row without an id is judged by its text and never linked; columns besides doc_id, text, n_chars and lang
pass through untouched, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skysift.llm import compression_classifier, packing, parity_join, pii, quality_rules
from skysift.llm.queries import tokenizer_file
from skysift.llm.support import documents, materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores as good. Without labels of both classes all score 0.5 and stay;
    a null or empty text has the score of an empty one."""
    return compression_classifier.keep_good(docs, compression_classifier.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and those calibrated for their language. Null, empty and short texts go; without
    labels the base rules alone decide."""
    return quality_rules.keep_passing(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar ones, that with the least id; rows without an id stay, and so do texts
    without words, which are linked with nothing."""
    return parity_join.first_of_each(docs)


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked in text and n_chars counted anew; a null text stays null."""
    return pii.redact(docs, pii.fit(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in training sequences; a null or empty text is the closing id alone."""
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_filter),
    ("near_duplicates", near_duplicates),
    ("pii", redaction),
    ("packing", packed),
]

#: Compression, boosted trees and tokenizers can't be put in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
