"""Clean a corpus: reject bad documents, near copies and benchmark leaks, redact secrets, encode.

Each stage takes the documents that the one before it left, as Parquet read again, with all their columns. The last returns
a row for each document that is left: its token count, the digest of its token ids and that of the text they decode to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opsmart.llm import bpe, decontaminate, quality_cnn, secrets, simhash
from opsmart.llm.common import table
from opsmart.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier rejects."""
    return quality_cnn.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    return simhash.keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents in which a passage of the benchmark occurs."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; every document stays."""
    return secrets.redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode what is left, and decode it again."""
    return bpe.bpe_round_trip(docs)


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("bpe encoding and decoding", encoding),
]

#: The classifier and the fingerprints are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    *filters, (_, last) = STAGES
    for name, stage in filters:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return last(spark, docs, sf_dir)
