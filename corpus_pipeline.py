"""A training-corpus pipeline: five stages, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymill.llm import classifier, exact_dedup, mixing, pieces, simhash
from waymill.operators.shared import materialize, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier marks 0 go."""
    return classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal after lower-casing A-Z the largest doc_id stays."""
    return exact_dedup.keep_first_of_equal(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the smallest doc_id stays."""
    return simhash.keep_one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources replicated to their tempered shares and shuffled."""
    return mixing.mix(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and what they decode to, as digests."""
    return pieces.digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("simhash near-dedup", near), ("mixing", mixed), ("sentencepiece", encoded)]

#: The classifier and the tokenizer are not expressible; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = materialize(docs, f"stage{at}")
    return docs
