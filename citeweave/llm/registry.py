"""Queries and SQL of the operators in this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from citeweave.llm import classify, media, mixing, ngramjoin, packing, pii, sharding, spotsigs, urlrules


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_document_fingerprints": spotsigs.op1_document_fingerprints,
        "op2_sharding": sharding.op2_sharding,
        "op3_ngram_jaccard_join": ngramjoin.op3_ngram_jaccard_join,
        "op4_url_filters": urlrules.op4_url_filters,
        "op5_best_fit_packing": packing.op5_best_fit_packing,
        "op6_source_mixing": mixing.op6_source_mixing,
        "op7_quality_classifier": classify.op7_quality_classifier,
        "op8_media_columns": media.op8_media_columns,
        "op9_personal_data": pii.op9_personal_data,
        "op10_toxicity": classify.op10_toxicity,
    }


def oracle_sql() -> dict[str, str]:
    """For what SQL expresses without a trained model, a tokenizer, an image or Spark's own hash functions."""
    return {"op2_sharding": sharding.SQL, "op3_ngram_jaccard_join": ngramjoin.SQL, "op4_url_filters": urlrules.SQL}
