"""Corpus pipeline: each stage applies one operator to all that the stage before
it kept. Stages are written as Parquet and read again, so a lost executor costs
a stage at most.

All stages take null ids, null, empty and very long texts, repeated rows and empty
tables; all but the last keep the columns of their input, whatever they are called.
An empty table stays empty through every stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daypulse.llm import exact_dedup, mixing, packing, simhash, toxicity
from daypulse.llm.common import documents, saved, table, text_batches


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject. Null and empty texts
    score half the prior and stay; repeated rows stay or go together; without
    labels nothing is rejected."""
    return toxicity.reject(text_batches(spark), docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest as written, then the
    smallest id (null is larger than any); of rows equal in both one stays. All
    null, empty and blank texts are one group."""
    return exact_dedup.keep_one(text_batches(spark), docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest id. Texts
    without words have fingerprint zero and link like any other."""
    return simhash.keep_one(text_batches(spark), docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; copies are equal rows. Null
    sources are one source, the last; texts without words count zero words and
    are taken like the others of their source; rows that repeat an id and its
    text share a draw."""
    return mixing.mix(text_batches(spark), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place. Null and empty texts are their
    end id; a text of more than 4,096 ids is cut, none is dropped."""
    return packing.pack_documents(text_batches(spark), docs)


STAGES = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("simhash near-dedup", without_near_copies),
    ("mix sources", mixed),
    ("best-fit packing", packed),
]

#: Viterbi decoding, SimHash components and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = saved(spark, docs, f"stage-{k}")
    return docs
