"""A corpus pipeline: five stages, each on all that the one before kept.

Every stage is written as Parquet to the shared folder and read again, so a
lost executor costs one stage's work at most and no stage recomputes another.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tributary.llm import jaccard, mixing, quality, secrets, sentencepieces
from tributary.session import settled, use_utc
from tributary.sources.tables import read_table

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the positive-unlabelled classifier rejects."""
    return quality.accepted(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality"))


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return jaccard.one_of_each(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mark; no document goes."""
    return secrets.redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and leave out documents so that sources meet their targets."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode: ids of the pieces, their first bytes in the text, and the digests of a round trip."""
    kept = docs.select("doc_id", "text", "source", "lang")
    encoded = sentencepieces.encoded(kept, MODEL, keep=("source", "lang"))
    return sentencepieces.digests(encoded, "source", "lang", "ids")


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_per_group),
    ("secrets", without_secrets),
    ("mixing", mixed),
    ("sentencepiece", tokens),
]
# classifiers, automata and the tokenizer's merges are beyond SQL; tests/llm/test_pipeline.py checks each stage instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(use_utc(spark), sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
