"""Direct and retail sales by reference SKU."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from opsmart.operators.match import enrich, lookup_chain


def shop_ref_mapping(lines: DataFrame, sku: DataFrame) -> DataFrame:
    """Distinct items sold in the shop and the master SKU they match, if any."""
    items = lines.select("sku", F.col("name").alias("shop_name"), F.col("product_id").alias("shop_id")).distinct()
    return enrich(items, sku, "sku", "sku", {"sku": "ref_sku", "sku_name": "ref_sku_name"}).drop("sku")


def d2c_sales(orders: DataFrame, lines: DataFrame, sku: DataFrame) -> DataFrame:
    """Order lines whose SKU is in the master, with the purchase date."""
    sold = lines.select("order_id", "sku", "quantity")
    names = sku.select("sku", "sku_name")
    dates = orders.select("order_id", F.col("processed_timestamp").cast("date").alias("date_purchased"))
    return sold.join(names, "sku", "inner").join(dates, "order_id", "inner").select(
        "sku", "sku_name", "date_purchased", "quantity"
    )


def item_ref_mapping(items: DataFrame, sku: DataFrame) -> DataFrame:
    """Ledger items to master SKUs: by SKU, then by UPC, then by name."""
    chain = [("stock_keeping_unit", "sku"), ("stock_keeping_unit", "upc"), ("name", "sku")]
    return lookup_chain(items, sku, chain, {"sku": "ref_sku", "sku_name": "ref_sku_name"}).select(
        F.col("id").alias("qb_id"), F.col("name").alias("qb_name"), "ref_sku", "ref_sku_name"
    )


def retail_sales(invoices: DataFrame, lines: DataFrame, items: DataFrame, mapping: DataFrame) -> DataFrame:
    """Invoiced item lines with reference SKU, date and amount."""
    dated = invoices.select(F.col("id").alias("_invoice"), F.col("transaction_date").alias("date_purchased"))
    sold = lines.filter(F.col("sales_item_item_id").isNotNull()).select(
        "invoice_id", F.col("sales_item_item_id").alias("_item"), "amount"
    )
    joined = sold.join(dated, F.col("invoice_id") == F.col("_invoice"), "inner")
    joined = enrich(joined, items, "_item", "id", {"name": "qb_sku_name"})
    joined = enrich(joined, mapping, "_item", "qb_id", {"ref_sku": "ref_sku", "ref_sku_name": "_ref_name"})
    return joined.select(
        "ref_sku", "qb_sku_name", F.coalesce("_ref_name", "qb_sku_name").alias("sku_name"), "date_purchased", "amount"
    )


def unmapped_lines(lines: DataFrame) -> DataFrame:
    """Invoice lines that name no item."""
    return lines.filter(F.col("sales_item_item_id").isNull())
