"""The registered ``opN_`` queries: each applies its operator, with production
parameters, to the whole table and derives the columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from martforge.llm import (chat, fim, fingerprint, langid, mixing, neardup, oracle, packing, piecebpe, quality, spans,
                           tokens, warc, whitening)
from martforge.llm.scratch import settings


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    settings(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(spark, _table(spark, sf_dir, "documents"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(said).alias("text"))
    return chat.report(turns.unionByName(extra))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(spark, _table(spark, sf_dir, "pages"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(spark, _table(spark, sf_dir, "documents"))


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_report(spark, _table(spark, sf_dir, "documents"))


def op8_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(_table(spark, sf_dir, "documents"), tokens.model_path(tokens.MODEL))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, _table(spark, sf_dir, "documents"), tokens.model_path(tokens.MODEL))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.removal_report(spark, _table(spark, sf_dir, "documents"))


def op11_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piecebpe.piece_report(_table(spark, sf_dir, "documents"), tokens.model_path(piecebpe.MODEL))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_embeddings(spark, _table(spark, sf_dir, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fim_report(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_near_dedup, op2_chat_format, op3_source_mix, op4_quality_forest, op5_warc_index, op6_language_id,
    op7_fingerprint, op8_token_count, op9_best_fit_packing, op10_substring_dedup, op11_piece_bpe,
    op12_whitening, op13_fill_in_middle)}

ORACLE = {k: v for k, v in oracle.SQL.items() if k in QUERIES}
