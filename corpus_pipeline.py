"""A corpus through five operators: quality classifier, SimHash near-dedup,
substring dedup, benchmark decontamination, SentencePiece encoding.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but
the last return the columns of ``documents``. ``run`` writes each stage's
result as Parquet into the shared folder and reads it for the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, quality, sentencepieces, simhash, substrings
from tessera.llm.common import materialise, ship, table
from tessera.llm.token_files import tokenizer_path

SHINGLE_WORDS = 4
MAX_BITS = 4


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject as of low
    quality or toxic."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id."""
    ship(spark)
    return simhash.drop_near_duplicates(docs, SHINGLE_WORDS, MAX_BITS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 50 words or more that a document
    with a smaller id has."""
    ship(spark)
    return substrings.without_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that are contaminated with benchmark items."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of pieces and digests of ids, decoded text and spans."""
    ship(spark)
    model = tokenizer_path("piece_bpe_32k.model")
    return sentencepieces.digest_pieces(docs.select("doc_id", "text"), model).select("row.doc_id", "out.*")


STAGES = [
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("sentencepiece encoding", sentencepiece),
]

# The classifier and the fingerprints are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return docs
