"""Invoices, estimates, ledger periods, budget."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from opsmart.functions.dates import with_period
from opsmart.functions.text import strip_leading_zeros
from opsmart.operators.match import enrich


def _document(doc: DataFrame, customers: DataFrame, number: str, extra: list[str]) -> DataFrame:
    named = enrich(doc, customers, "customer_id", "id", {"fully_qualified_name": "customer"})
    po = F.col("custom_purchase_order_number")
    return named.select(
        F.col("doc_number").alias(number),
        F.col("id").alias("qb_id"),
        *extra,
        F.col("currency_id").alias("currency"),
        "total_amount", "ship_date", "transaction_date", "customer_id", "customer",
        po.alias("po_number"),
        strip_leading_zeros(po).alias("po_number_trim"),
        F.col("custom_store_number").alias("store_number"),
        F.col("custom_warehouse").alias("warehouse"),
        F.col("private_note").alias("memo"),
        "billing_address_id", "shipping_address_id", "created_at", "updated_at",
    )


def estimates_view(estimates: DataFrame, customers: DataFrame) -> DataFrame:
    return _document(estimates, customers, "estimate_id", ["transaction_status"])


def invoices_view(invoices: DataFrame, customers: DataFrame) -> DataFrame:
    return _document(invoices, customers, "invoice_id", [])


def invoice_estimate_ref(invoices: DataFrame, links: DataFrame, estimates: DataFrame, customers: DataFrame) -> DataFrame:
    """Which estimate each numbered invoice came from, if any."""
    docs = invoices.filter(F.col("doc_number").isNotNull()).select(
        F.col("doc_number").alias("invoice_id"), F.col("id").alias("qb_invoice_id"), "customer_id"
    )
    docs = enrich(docs, links, "qb_invoice_id", "invoice_id", {"estimate_id": "qb_estimate_id"})
    docs = enrich(docs, estimates, "qb_estimate_id", "id", {"doc_number": "estimate_id"})
    docs = enrich(docs, customers, "customer_id", "id", {"fully_qualified_name": "customer"})
    return docs.select("invoice_id", "qb_invoice_id", "estimate_id", "qb_estimate_id", "customer", "customer_id")


def ledger_periods(df: DataFrame, day: str) -> DataFrame:
    """A copy of a ledger with the first and last day of each row's month."""
    return with_period(df, day)


def budget(detail: DataFrame, budgets: DataFrame, accounts: DataFrame) -> DataFrame:
    """Budget lines with budget and account names; the budget date becomes the
    period's first day."""
    named = budgets.select(F.col("id").alias("budget_id"), F.col("name").alias("budget_name"))
    account = accounts.select(
        F.col("id").alias("account_id"), F.col("classification").alias("account_class"),
        F.col("name").alias("account_name"), "account_type",
    )
    joined = detail.join(named, "budget_id", "inner").join(account, "account_id", "inner")
    kept = [c for c in detail.columns if c != "budget_date"]
    return joined.select(
        *kept, "account_class", "budget_name", "account_name", "account_type",
        F.col("budget_date").alias("period_first_day"), F.last_day("budget_date").alias("period_last_day"),
    )
