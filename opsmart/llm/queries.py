"""The operators applied to whole tables, one query each, and their SQL where SQL can say it.

The queries narrow an operator's own output to the columns that are compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from opsmart.llm import decontaminate, hard_negatives, vector_codes
from opsmart.llm.common import table

Run = Callable[[SparkSession, str], DataFrame]


def _token_counts(spark: SparkSession, folder: str) -> DataFrame:
    from opsmart.llm.token_counts import token_counts

    return token_counts(table(spark, folder, "documents"))


def _bpe(spark: SparkSession, folder: str) -> DataFrame:
    from opsmart.llm.bpe import bpe_round_trip

    return bpe_round_trip(table(spark, folder, "documents"))


def _perplexity(spark: SparkSession, folder: str) -> DataFrame:
    from opsmart.llm.perplexity import quality_rules

    return quality_rules(table(spark, folder, "documents"))


def _decontamination(spark: SparkSession, folder: str) -> DataFrame:
    from opsmart.llm.decontaminate import contaminated

    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def _licenses(spark: SparkSession, folder: str) -> DataFrame:
    from opsmart.llm.licenses import license_labels

    return license_labels(table(spark, folder, "documents"))


def _quality(spark: SparkSession, folder: str) -> DataFrame:
    from opsmart.llm.quality_cnn import classify

    return classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def _toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from opsmart.llm.toxicity import classify

    return classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def _secrets(spark: SparkSession, folder: str) -> DataFrame:
    from opsmart.llm.secrets import secret_spans

    return secret_spans(table(spark, folder, "documents"))


def _simhash(spark: SparkSession, folder: str) -> DataFrame:
    from opsmart.llm.simhash import near_duplicate_components

    return near_duplicate_components(table(spark, folder, "documents"))


def _windows(spark: SparkSession, folder: str) -> DataFrame:
    from opsmart.llm.suffix_dedup import removed_windows

    return removed_windows(table(spark, folder, "documents"))


def _files(spark: SparkSession, folder: str) -> DataFrame:
    from opsmart.llm.token_files import token_files

    return token_files(table(spark, folder, "documents"), with_ids=False)


def _negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, folder, "embeddings"))


def _codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, folder, "embeddings"))


QUERIES: dict[str, Run] = {
    "op1_perplexity_rules": _perplexity,
    "op2_benchmark_decontamination": _decontamination,
    "op3_license_scans": _licenses,
    "op4_quality_classifier": _quality,
    "op5_toxicity": _toxicity,
    "op6_secret_scans": _secrets,
    "op7_token_counts": _token_counts,
    "op8_simhash_near_duplicates": _simhash,
    "op9_bpe_round_trip": _bpe,
    "op10_suffix_dedup": _windows,
    "op11_token_files": _files,
    "op12_hard_negatives": _negatives,
    "op13_vector_codes": _codes,
}

SQL: dict[str, str] = {
    "op2_benchmark_decontamination": decontaminate.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
    "op13_vector_codes": vector_codes.SQL,
}
