"""The corpus pipeline: quality rules, quality classifier, exact and near
deduplication, then packing into training sequences.

Each stage works on all that the stage before it kept; every stage but the last
returns the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from propensia.llm import exact_dedup, fertility, ngram_join, packing, quality_model, queries
from propensia.llm.common import read, scratch, stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the word rules and the tokeniser-fertility bands accept."""
    return fertility.drop_rejected(docs, queries.PIECE_MODEL)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model holds for clean."""
    model = quality_model.fit_model(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return quality_model.drop_low_grades(docs, model)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that 4-word shingles link."""
    return ngram_join.drop_near_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left and their places in the sequences."""
    return packing.pack_documents(docs, queries.WORD_JSON)


STAGES = [("quality_rules", quality_rules), ("quality_classifier", quality_classifier), ("exact_dedup", exact_duplicates),
          ("ngram_join", near_duplicates), ("best_fit_packing", pack)]

#: SQL has no tokenizer and no model; the tests run a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the documents that all stages keep; a stage's own folders go when its result is written."""
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        with scratch() as keep:
            docs = stage(function(spark, docs, sf_dir), name)
            keep.add(docs.staged_at)
    return STAGES[-1][1](spark, docs, sf_dir)
