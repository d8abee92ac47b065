"""The registered queries of the operators, over the whole intended tables.

Each query calls its operator and derives the columns it returns from the
operator's rows.  SQL twins are given where SQL can say the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.llm import (
    bit_mixing,
    digest_index,
    importance,
    langid,
    line_spread,
    mixing,
    near_join,
    order_minhash,
    packing,
    quality,
    token_records,
    vector_codes,
    warc,
)
from caseflow.llm.common import crc_mod


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_join.near_duplicate_classes(documents(spark, sf_dir))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_documents(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bad_lines",
        *[f"n_{r}" for r in quality.RULES], "base_failed", "kept")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op5_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records.token_table(documents(spark, sf_dir)).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_bit_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_mixing.score_documents(documents(spark, sf_dir), crc_mod("doc_id", 7) != 2)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = crc_mod("doc_id", 5) == 0
    model = langid.learn_profiles(docs.where(~held_out))
    return langid.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")


def op8_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_spread.drop_spread_lines(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_removed", "text")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprint_documents(documents(spark, sf_dir))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return importance.resample(documents(spark, sf_dir), target).select(
        "doc_id", "n_features", "weight", "score", "rank")


def op12_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_index.exact_duplicates(documents(spark, sf_dir)).drop("row")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_near_join, op2_source_mix, op3_quality_rules, op4_warc, op5_token_records, op6_bit_mixing,
        op7_language_id, op8_line_spread, op9_packing, op10_order_minhash, op11_importance_resampling,
        op12_digest_index, op13_vector_codes)
}

ORACLES: dict[str, str] = {
    "op1_near_join": near_join.ORACLE,
    "op3_quality_rules": quality.ORACLE,
    "op4_warc": warc.ORACLE,
    "op8_line_spread": line_spread.ORACLE,
    "op11_importance_resampling": importance.ORACLE,
    "op12_digest_index": digest_index.ORACLE,
    "op13_vector_codes": vector_codes.oracle(),
}
