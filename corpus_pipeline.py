"""A training corpus from documents: quality rules, near-deduplication, secrets, mixing, pieces.

Each stage takes (spark, docs, sf_dir), reads all that its predecessor kept, and returns a
DataFrame with the columns of documents, the last one doc_id and ids. run() writes each stage's
result as Parquet to the shared folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from obslake.llm import mixing, near_dedup, pieces, quality, queries, secret_scans as secrets
from obslake.llm.common import cut, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.kept_documents(docs, queries.trusted_ids(spark, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.deduplicated(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    return secrets.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in shards and shuffled."""
    return mixing.mixed(docs)


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document: doc_id, n_ids, ids, exact."""
    return pieces.encoded_and_checked(docs)


STAGES = [("quality rules", quality_rules), ("minhash near-dedup", near_duplicates), ("secret scans", secret_scans),
          ("source mixing", source_mix), ("sentencepiece", sentence_pieces)]

# shingle sketches, hashed n-grams and piece lattices are no SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
