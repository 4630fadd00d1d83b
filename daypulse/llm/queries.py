"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daypulse.llm import (
    align, bitpack, chat, exact_dedup, html_text, mixing, packing, quality, sharding, simhash, substring,
    toxicity, whitening)
from daypulse.llm.common import documents, table, text_batches


def _over_documents(operator: Callable[[SparkSession, DataFrame], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(text_batches(spark), documents(spark, sf_dir))

    run.__name__, run.__doc__ = operator.__name__, operator.__doc__
    return run


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.op1_chat_formatting(text_batches(spark), table(spark, sf_dir, "conversations"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op3_toxicity(text_batches(spark), documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.op11_embedding_whitening(spark, table(spark, sf_dir, "embeddings"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.op12_html_extraction(text_batches(spark), table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": op1_chat_formatting, "op3_toxicity": op3_toxicity,
    "op11_embedding_whitening": op11_embedding_whitening, "op12_html_extraction": op12_html_extraction}
QUERIES |= {
    f.__name__: _over_documents(f) for f in (
        substring.op2_substring_dedup, exact_dedup.op4_exact_dedup, simhash.op5_simhash, quality.op6_quality_rules,
        sharding.op7_balanced_sharding, bitpack.op8_bit_packing, mixing.op9_mix_sources,
        packing.op10_best_fit_packing, align.op13_tokenizer_alignment)}

ORACLE: dict[str, str] = {
    "op1_chat_formatting": chat.OP1_SQL.strip(),
    "op2_substring_dedup": substring.OP2_SQL.strip(),
    "op4_exact_dedup": exact_dedup.OP4_SQL.strip(),
    "op6_quality_rules": quality.OP6_SQL.strip(),
    "op9_mix_sources": mixing.OP9_SQL.strip(),
}
