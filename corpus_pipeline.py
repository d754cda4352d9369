"""A training corpus from `documents`: five stages, each written as Parquet and read again by the next.

Language identification drops what is no text of a known language, exact and near deduplication keep one document of each
group, mixing brings the sources to their target weights, and BPE turns the texts into tokens and checks that they decode.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpuscle.llm import bpe, exact_dedup, langid, mixing, simhash
from corpuscle.llm.common import col, new_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language the classifier recognises."""
    return langid.accepted(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each text."""
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, with or without an id of its own."""
    return simhash.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Brings the sources to the roots of their sizes as weights, within the tokens there are; small sources repeat."""
    return mixing.mixed(docs).select(*[col(c) for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the token ids and whether they decode to the text."""
    return bpe.encode(docs)


STAGES: list[tuple[str, Stage]] = [("language_id", language), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix), ("bpe", tokens)]

#: SQL can't express the classifier, the fingerprints or the encoder; the tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; what lies between them is kept in the shared folder until clean()."""
    folder = new_dir(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{i}-{name}")
            docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs
