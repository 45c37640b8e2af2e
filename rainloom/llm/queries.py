"""The training-data queries: name -> (spark, sf_dir) -> DataFrame, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, importance, languages, media, mixing, phrases, sharding, simhash, superkmers, token_blocks, topk, toxicity, whitening
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def _over_documents(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_flac_media": _over_documents(media.query),
    "op2_toxicity": lambda spark, sf_dir: toxicity.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op3_decontamination": lambda spark, sf_dir: phrases.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
    "op4_token_blocks": _over_documents(token_blocks.query),
    "op5_chat_formatting": lambda spark, sf_dir: chat.query(table(spark, sf_dir, "conversations")),
    "op6_pareto_mixing": _over_documents(mixing.query),
    "op7_language_id": _over_documents(languages.query),
    "op8_substring_dedup": _over_documents(superkmers.query),
    "op9_simhash_near_dedup": _over_documents(simhash.query),
    "op10_jump_sharding": _over_documents(sharding.query),
    "op11_topk_search": lambda spark, sf_dir: topk.query(table(spark, sf_dir, "embeddings")),
    "op12_importance_resampling": lambda spark, sf_dir: importance.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
    "op13_embedding_whitening": lambda spark, sf_dir: whitening.query(table(spark, sf_dir, "embeddings")),
}

ORACLE: dict[str, str] = {
    "op3_decontamination": phrases.ORACLE,
    "op5_chat_formatting": chat.ORACLE,
    "op6_pareto_mixing": mixing.ORACLE,
    "op8_substring_dedup": superkmers.ORACLE,
    "op10_jump_sharding": sharding.ORACLE,
    "op11_topk_search": topk.ORACLE,
    "op12_importance_resampling": importance.ORACLE,
}
