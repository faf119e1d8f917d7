"""A training corpus from documents: five stages, each written as Parquet and read again.

Quality rules drop documents, near-duplicates leave one of each group (shingles of five
words, similarity of 0.8 or more), decontamination drops leaks of ``benchmark``, personal
data are replaced in the texts, and the rest is encoded; the last stage returns a digest of
each document's piece ids.

Null and empty texts have too few words and go in the first stage, as do rows that repeat in
the second, but for one. Of documents that are equally good to keep the one of the smallest
id stays; texts without an id stand for themselves. Very long texts are taken whole by every
stage. Further columns, whatever their names, stay until the last stage. An empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from copperleaf.llm import decontamination, near_duplicates, pii, quality_rules, sentence_pieces
from copperleaf.llm.common import shared_dir


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.keep_one(docs, k=5, percent=80)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def private_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentence_pieces.encoded_digest(docs, sentence_pieces.model_path())


STAGES = [
    ("quality rules", good_documents),
    ("near-duplicates", distinct_documents),
    ("decontamination", clean_documents),
    ("personal data", private_documents),
    ("sentence pieces", encoded_documents),
]

#: SQL cannot express the near-duplicates; tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_dir(spark)
    for number, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path := f"{folder}/stage-{number}")
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
