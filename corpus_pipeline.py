"""From documents to token ids: quality rules, near-duplicates, decontamination, personal data, BPE.

Each stage gets the rows that the one before it kept, as a written table. All but the last return the columns of
``documents``; the last returns doc_id, n_tokens and ids. Rows without a text, or with an empty one, go in the first stage.
Of rows that share doc_id and text one stays. An empty table passes through all stages.
"""

from __future__ import annotations

import os
import sys

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.llm import decontaminate, pii, quality, reuse, sketches  # noqa: E402
from tessera.llm.common import table  # noqa: E402
from tessera.sources.workspace import materialize  # noqa: E402


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that a quality rule rejects."""
    return quality.kept_documents(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    return sketches.distinct_documents(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in the texts; n_chars follows."""
    return pii.masked_documents(docs).withColumn("n_chars", F.length("text").cast("long"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts."""
    rows = reuse.token_rows(docs, public_tokenizers.path("word_bpe_49k.json"))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality_stage),
    ("near_duplicates", dedup_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", pii_stage),
    ("bpe", bpe_stage),
]
#: Fitted models and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
