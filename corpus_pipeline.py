"""A training corpus from raw documents: filter by quality, drop exact and near copies, mix sources, encode.

Each stage works on all that the one before kept, written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from docloom.llm import dedup, mix, near_dedup, quality  # noqa: E402
from docloom.llm.common import load, settle, ship  # noqa: E402
from docloom.llm.queries import encoded_digests, tokenizer_path  # noqa: E402


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the adaptive fences."""
    ship(spark)
    return quality.keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per text, that with the smallest doc_id."""
    ship(spark)
    return dedup.drop_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per group of near copies: 5-word shingles, similarity of at least 0.8."""
    ship(spark)
    return near_dedup.drop_near_copies(docs, words=5)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document may come several times."""
    ship(spark)
    return mix.mixed_documents(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document of the mix: doc_id, number of ids, digests of the ids and of the decoded text."""
    ship(spark)
    return encoded_digests(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup_stage),
    ("source_mix", source_mix),
    ("bpe_encoding", bpe_encoding),
]

#: Similarity components, seeded mixing and byte-pair merges have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
