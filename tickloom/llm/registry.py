"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import bpe, chat, htmlmain, langid, minhash, packing, quality, resample, suffix, topk, toxicity, variants, vptree
from tickloom.llm.common import table


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(table(spark, sf_dir, "documents"))


def op2_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmlmain.extract(table(spark, sf_dir, "pages"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.op5(table(spark, sf_dir, "embeddings"))


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op7_vantage_point_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(table(spark, sf_dir, "embeddings"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.removal_digest(table(spark, sf_dir, "documents"), passage=suffix.PASSAGE)


def op9_quote_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(table(spark, sf_dir, "conversations"))


def thread_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What operator 9 builds: whole conversations, in parts."""
    return chat.conversations(table(spark, sf_dir, "conversations"))


def op10_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.classify(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.forms(variants.vocabulary(table(spark, sf_dir, "documents")))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_minhash_near_dedup": op1_minhash_near_dedup,
        "op2_compression_toxicity": op2_compression_toxicity,
        "op3_html_main_text": op3_html_main_text,
        "op4_best_fit_packing": op4_best_fit_packing,
        "op5_exact_topk": op5_exact_topk,
        "op6_bpe_round_trip": op6_bpe_round_trip,
        "op7_vantage_point_trees": op7_vantage_point_trees,
        "op8_suffix_dedup": op8_suffix_dedup,
        "op9_quote_threads": op9_quote_threads,
        "op10_attention_quality": op10_attention_quality,
        "op11_language_id": op11_language_id,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_importance_resampling": op13_importance_resampling,
        "thread_conversations": thread_conversations,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_exact_topk": topk.ORACLE_SQL, "op9_quote_threads": chat.ORACLE_SQL, "op12_spelling_variants": variants.ORACLE_SQL, "op13_importance_resampling": resample.ORACLE_SQL, "thread_conversations": chat.CONVERSATIONS_SQL}
