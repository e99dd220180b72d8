"""The operators as queries over the whole tables of a folder: name -> f(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellstrand.llm import ann, byte_bpe, decontaminate, filter_audit, jaccard_join, lm_scoring, pivot_topk
from cellstrand.llm import quality, suffix_dedup, token_alignment, token_counts, token_files, toxicity
from cellstrand.llm.common import table

TOXIC_FROM = 0.7
GOOD_FROM = 0.3
END_ID = 2


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = toxicity.held_out(3, 1)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held)
    return toxicity.score(docs, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents")).withColumn("log_score", F.round("log_score", 4))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encoding_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), END_ID)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = toxicity.held_out(5, 0)
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~held)
    return quality.score(docs, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_token_counts": op2_token_counts,
        "op3_jaccard_join": op3_jaccard_join,
        "op4_lm_scoring": op4_lm_scoring,
        "op5_suffix_dedup": op5_suffix_dedup,
        "op6_decontaminate": op6_decontaminate,
        "op7_ann": op7_ann,
        "op8_byte_bpe": op8_byte_bpe,
        "op9_token_files": op9_token_files,
        "op10_quality": op10_quality,
        "op11_token_alignment": op11_token_alignment,
        "op12_filter_audit": op12_filter_audit,
        "op13_exact_topk": op13_exact_topk,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_jaccard_join": jaccard_join.ORACLE,
        "op4_lm_scoring": lm_scoring.ORACLE,
        "op5_suffix_dedup": suffix_dedup.ORACLE,
        "op6_decontaminate": decontaminate.ORACLE,
        "op12_filter_audit": filter_audit.ORACLE,
        "op13_exact_topk": pivot_topk.ORACLE,
    }
