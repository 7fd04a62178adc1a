"""The registered queries of the operators, with production parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyrill.llm import (
    decontamination,
    language_id,
    language_model,
    merkle,
    overlap_join,
    packing,
    quality,
    quotes,
    runs,
    sequence_files,
    simhash,
    sql,
    substrings,
    token_counts,
)
from keyrill.llm.common import table
from keyrill.streaming.jobs import work_folder


def op1_sequence_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoding = sequence_files.Encoding(public_tokenizers.path("word_bpe_49k.json"))
    manifest = sequence_files.write_sequences(table(spark, sf_dir, "documents"), work_folder(spark, "sequences"), encoding)
    return sequence_files.read_documents(manifest)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


def op3_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_order(table(spark, sf_dir, "conversations"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.learn(docs))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeated_spans(table(spark, sf_dir, "documents").select("doc_id", "text"), joined=True)
    return found.select(F.col("document.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2("document.text", 256).alias("kept_sha256"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_join.overlap_join(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(table(spark, sf_dir, "documents"), planted=True)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proofs(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_sequence_files,
        op2_decontamination,
        op3_quotation_linking,
        op4_language_id,
        op5_quality_rules,
        op6_substring_dedup,
        op7_token_counts,
        op8_simhash,
        op9_best_fit_packing,
        op10_attention_scores,
        op11_overlap_join,
        op12_periodic_runs,
        op13_merkle_manifest,
    )
}
ORACLES: dict[str, str] = dict(sql.ORACLES)
