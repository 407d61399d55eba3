"""EDI register, integration log and trading-partner mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from opsmart.functions.dates import parse_slash_date, parse_us_timestamp
from opsmart.functions.keys import file_line_id, row_id
from opsmart.functions.numbers import parse_amount
from opsmart.functions.text import code_of, label_of
from opsmart.operators.fuzzy import fuzzy_best_match
from opsmart.operators.load import incremental_load
from opsmart.operators.match import enrich


def best_partners(customers: DataFrame, register: DataFrame, min_sim: int = 85) -> DataFrame:
    """The most similar customer for each trading partner that has one."""
    known = customers.select("display_name", "id", "fully_qualified_name").distinct()
    partners = register.select(F.col("textbox_23").alias("tc_name"))
    found = fuzzy_best_match(partners, known, "tc_name", "display_name", min_sim, keep_unmatched=False)
    return found.select(
        F.col("id").alias("qb_id"), F.col("display_name").alias("qb_name"),
        F.col("fully_qualified_name").alias("qb_fq_name"), "tc_name",
    )


def partner_mapping(customers: DataFrame, register: DataFrame, target: DataFrame, min_sim: int = 85) -> DataFrame:
    """The mapping after adding customers not in it yet."""
    return incremental_load(best_partners(customers, register, min_sim), target, key="qb_id", latest="keep")


def parse_register(raw: DataFrame, mapping: DataFrame) -> DataFrame:
    """Register lines; lines without a partner, date or document are dropped."""
    day = parse_slash_date(F.col("textbox_17"))  # NULL for a malformed date, which must not stop the load
    keyed = raw.withColumn("transaction_id", row_id("textbox_23", "textbox_17", "textbox_19"))
    keyed = keyed.filter(F.col("transaction_id").isNotNull())
    joined = enrich(keyed, mapping, "textbox_23", "tc_name", {"qb_id": "trading_partner_qb_id"})
    return joined.select(
        "transaction_id",
        (F.col("_line") + 1).alias("index"),
        F.col("textbox_23").alias("trading_partner"),
        "trading_partner_qb_id",
        label_of(F.col("textbox_21")).alias("transaction_type"),
        code_of(F.col("textbox_21")).alias("transaction_type_id"),
        F.col("textbox_19").alias("doc_number"),
        F.col("alt_doc_num").alias("alt_doc_number"),
        parse_amount(F.col("txn_amount")).alias("amount"),
        day.alias("creation_date"),
        F.col("textbox_15").alias("folder"),
        F.trunc(day, "month").alias("period_first_day"),
        F.last_day(day).alias("period_last_day"),
        F.lit(True).alias("latest"),
        file_line_id().alias("_row_id"),
        "_modified", "_file", "_fivetran_synced",
    )


def parse_integration(raw: DataFrame, mapping: DataFrame) -> DataFrame:
    """Integration log lines."""
    stamp = parse_us_timestamp(F.col("document_date"))
    joined = enrich(raw, mapping, "edipartner_name", "tc_name", {"qb_id": "trading_partner_qb_id"})
    return joined.select(
        row_id("edipartner_name", "document_date", "alt_doc_id").alias("transaction_id"),
        (F.col("_line") + 1).alias("index"),
        F.col("edipartner_name").alias("trading_partner"),
        "trading_partner_qb_id",
        F.col("txn_type").alias("transaction_type"),
        F.col("alt_doc_id").alias("alt_doc_number"),
        F.col("account_id").alias("tc_account_id"),
        parse_amount(F.col("amount")).alias("amount"),
        stamp.alias("document_date"),
        parse_us_timestamp(F.col("log_time")).alias("log_time"),
        "description",
        F.trunc(stamp, "month").alias("period_first_day"),
        F.last_day(stamp).alias("period_last_day"),
        F.lit(True).alias("latest"),
        file_line_id().alias("_row_id"),
        "_modified", "_file", "_fivetran_synced",
    )
