"""The training-corpus pipeline: quality rules, exact dedup, near dedup, mixing, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which ``run`` writes as Parquet to
the shared folder and rereads as the next stage's ``docs``. All but the last return the columns of
``documents``; the last returns the packed pieces.

Edge cases, the same for all stages: an empty table gives an empty one; extra columns pass through under any
name; rows without a ``doc_id`` and rows that repeat one are rows of their own, judged by their text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from mailsync.llm.exact_dedup import drop_copies
from mailsync.llm.frames import documents, written
from mailsync.llm.mixing import sample_mix
from mailsync.llm.near_dup import drop_near_duplicates
from mailsync.llm.packing import pack_documents
from mailsync.llm.quality import good_documents


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null and empty texts have under 50 words and go."""
    return good_documents(docs)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest ``doc_id`` of each group of equal texts (null ids last; of equal ids the first row). Null counts as empty."""
    return drop_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest ``doc_id`` of each group of near-duplicates (null ids last). Texts without words are near nothing and stay."""
    return drop_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with tempered shares of sources, languages and topics. Null margins are a value of their own; rows
    without words stay by their cell's probability; rows without a ``doc_id`` share one hash."""
    return sample_mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of at most 4096 tokens. A null or empty text is one piece, the end id."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # the divergence verdicts and the packing are not SQL; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
