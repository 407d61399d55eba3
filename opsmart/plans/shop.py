"""Daily and monthly shop reports, rolling shop metrics, campaign orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from opsmart.functions.numbers import money, round_half_up
from opsmart.functions.text import any_ilike
from opsmart.operators.series import rolling_ratios
from opsmart.sources.tables import rename

# Report names of the daily shop measures.
DAILY_SHOP = {
    "date_day": "date_day",
    "shop_id": "shop_id",
    "currency": "currency",
    "count_orders": "order_count",
    "quantity_sold": "items_sold",
    "quantity_refunded": "items_refunded",
    "avg_line_item_count": "avg_items_per_order",
    "count_customers": "total_customers",
    "order_adjusted_total": "gross_sales",
    "total_discounts": "total_discounts",
    "refund_subtotal": "refund_subtotal",
    "refund_total_tax": "refund_total_tax",
    "shipping_cost": "shipping_cost",
    "shipping_discount_amount": "shipping_discount_amount",
    "order_adjustment_amount": "order_adjustment_amount",
    "order_adjustment_tax_amount": "order_adjustment_tax_amount",
    "count_discount_codes_applied": "discount_code_applied",
    "count_orders_with_discounts": "count_orders_with_discounts",
    "count_orders_with_refunds": "count_orders_with_refunds",
    "count_variants_sold": "variants_sold",
    "count_products_sold": "products_sold",
    "quantity_gift_cards_sold": "quantity_gift_cards_sold",
    "quantity_requiring_shipping": "quantity_requiring_shipping",
    "count_abandoned_checkouts": "count_abandoned_checkouts",
    "count_customers_abandoned_checkout": "count_customers_abandoned_checkout",
    "count_fulfillment_attempted_delivery": "count_fulfillment_attempted_delivery",
    "count_fulfillment_delivered": "count_fulfillment_delivered",
    "count_fulfillment_failure": "count_fulfillment_failure",
    "count_fulfillment_confirmed": "count_fulfillment_confirmed",
}

# Monthly totals, {report name: daily measure}.
MONTHLY_COUNTS = {
    "total_orders": "order_count",
    "total_items_sold": "items_sold",
    "total_items_refunded": "items_refunded",
    "total_customers": "total_customers",
    "total_discount_codes_applied": "discount_code_applied",
    "total_orders_with_discounts": "count_orders_with_discounts",
    "total_orders_with_refunds": "count_orders_with_refunds",
    "total_variants_sold": "variants_sold",
    "total_products_sold": "products_sold",
    "total_gift_cards_sold": "quantity_gift_cards_sold",
    "total_items_requiring_shipping": "quantity_requiring_shipping",
    "total_abandoned_checkouts": "count_abandoned_checkouts",
    "total_customers_abandoned_checkout": "count_customers_abandoned_checkout",
    "total_fulfillment_attempted_delivery": "count_fulfillment_attempted_delivery",
    "total_fulfillment_delivered": "count_fulfillment_delivered",
    "total_fulfillment_failure": "count_fulfillment_failure",
    "total_fulfillment_confirmed": "count_fulfillment_confirmed",
}
MONTHLY_MONEY = {
    "gross_sales": "gross_sales",
    "total_discounts": "total_discounts",
    "total_refund_subtotal": "refund_subtotal",
    "total_refund_tax": "refund_total_tax",
    "total_shipping_cost": "shipping_cost",
    "total_shipping_discount": "shipping_discount_amount",
    "total_order_adjustment": "order_adjustment_amount",
    "total_order_adjustment_tax": "order_adjustment_tax_amount",
}


def daily_shop_key(daily_shop: DataFrame) -> DataFrame:
    """Live daily shop rows under their report names."""
    return rename(daily_shop.filter(~F.col("is_deleted")), DAILY_SHOP)


def daily_shop_report(spine: DataFrame, key: DataFrame) -> DataFrame:
    """Daily shop rows with all calendar attributes, in date order."""
    return spine.join(key, spine["date"] == key["date_day"], "inner").drop("date_day").orderBy("date")


def monthly_shop_report(spine: DataFrame, key: DataFrame, round_avg_items: bool = True) -> DataFrame:
    """Monthly totals per shop and currency, in month order."""
    months = spine.select("date", "year", "month_number", "month_text", "month_year")
    joined = months.join(key, months["date"] == key["date_day"], "inner")
    average = F.avg("avg_items_per_order")
    out = joined.groupBy("year", "month_number", "month_text", "month_year", "shop_id", "currency").agg(
        *[F.sum(c).alias(n) for n, c in MONTHLY_COUNTS.items()],
        (round_half_up(average, 2) if round_avg_items else average).alias("avg_items_per_order"),
        *[F.sum(money(F.col(c))).cast("double").alias(n) for n, c in MONTHLY_MONEY.items()],
    )
    return out.orderBy("year", "month_number")


def rolling_shop_metrics(spine: DataFrame, key: DataFrame, rows: int = 30) -> DataFrame:
    """Ratios over the shop's last ``rows`` reported days, in date order."""
    days = spine.select("date")
    joined = days.join(key, days["date"] == key["date_day"], "inner")
    values = {
        "orders": F.col("order_count"),
        "items": F.col("items_sold"),
        "sales": money(F.col("gross_sales")),
        "discounts": money(F.col("total_discounts")),
        "refunds": money(F.col("refund_subtotal")),
        "shipping": money(F.col("shipping_cost")),
    }
    suffix = f"_{rows}_day"
    ratios = {
        f"average_order_value{suffix}": ("sales", "orders", 2),
        f"items_per_order{suffix}": ("items", "orders", 2),
        f"discount_percentage{suffix}": ("discounts", "sales", 6),
        f"refund_percentage{suffix}": ("refunds", "sales", 6),
        f"shipping_revenue_per_order{suffix}": ("shipping", "orders", 2),
    }
    out = rolling_ratios(joined, ["shop_id", "currency"], "date", rows, values, ratios)
    return out.select("date", "shop_id", "currency", *ratios).orderBy("date")


def campaign_orders(orders: DataFrame, patterns: list[str], since: str, flag_name: str = "campaign_sale") -> DataFrame:
    """Paid, uncancelled orders after ``since``, flagged by their URL tags."""
    kept = orders.filter(
        F.col("cancelled_timestamp").isNull()
        & (F.col("financial_status") == "paid")
        & (F.col("created_timestamp") > F.lit(since).cast("timestamp"))
    )
    return kept.select(
        F.col("name").alias("order_id"),
        "total_line_items_price",
        "total_discounts",
        "total_price",
        "total_tax",
        "shipping_cost",
        F.col("created_timestamp").alias("order_datetime"),
        "referring_site",
        "order_tags",
        "order_url_tags",
        "new_vs_repeat",
        any_ilike(F.col("order_url_tags"), patterns).alias(flag_name),
    )
