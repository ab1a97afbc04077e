"""The registered queries of this package and their DuckDB twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, divergence, language, licenses, lm, pii, quality, repeats, reuse, sketches, tokens, warc, whitening
from tessera.llm.common import table


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_table(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_gru_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(table(spark, sf_dir, "documents"))


def op3_language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "documents"))


def op4_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removed(table(spark, sf_dir, "documents")).drop("kept")


def op5_license_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


def op6_chunk_reuse_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reuse.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_bilstm_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scanned(table(spark, sf_dir, "documents"))


def op8_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def op10_setsketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.near_duplicates(table(spark, sf_dir, "documents"))


def op11_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_token_files, op2_gru_class_lm, op3_language_centroids, op4_suffix_repeats, op5_license_signatures, op6_chunk_reuse_bpe, op7_bilstm_crf_pii, op8_positional_index, op9_quality_cascade,
        op10_setsketch_dedup, op11_warc_dictionary, op12_embedding_whitening, op13_source_divergence,
    )
}
TWINS = {
    "op8_positional_index": decontaminate.ORACLE, "op9_quality_cascade": quality.ORACLE, "op10_setsketch_dedup": sketches.ORACLE,
    "op11_warc_dictionary": warc.ORACLE, "op13_source_divergence": divergence.ORACLE,
}
