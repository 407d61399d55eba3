"""Purchase orders: status map, vendor map, tracker, prices over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from opsmart.functions.dates import leading_date, serial_date
from opsmart.functions.keys import sync_line_id
from opsmart.functions.numbers import MONEY, ratio
from opsmart.functions.text import flag
from opsmart.operators.fuzzy import fuzzy_best_match
from opsmart.operators.load import attach_max
from opsmart.operators.match import enrich, enrich_roles
from opsmart.operators.series import running_by_day, running_sums
from opsmart.plans.sku import DELETED_VENDOR
from opsmart.session import materialise

NOT_A_NAME = "N/A"
COMPLETE = "COMPLETE"

# Tracker columns taken over unchanged.
TERMS = [
    "payment_terms", "pmt_upfront_percent", "pmt_upfront_net", "pmt_upfront_addl_percent", "pmt_upfront_addl_net",
    "pmt_ship_percent", "pmt_ship_net", "pmt_delivery_percent", "pmt_delivery_net", "pmt_cc", "pmt_cc_percent",
    "pmt_check", "new_launch",
]
CLEAN_COLUMNS = [
    "master_po_num", "status", "brand", "sku", "sku_name", "upc", "po_type", "fg_po_association", "po_date",
    "ship_date_actual", "delivery_date_actual", "ship_from", "ship_from_id", "ship_to", "ship_to_id", "quantity",
    "quantity_received", "per_unit_order", "per_unit_effective", "payment_terms",
]


def po_status(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("po_statuses").alias("status"), "type")


def ship_names(tracker_raw: DataFrame) -> DataFrame:
    """Distinct trimmed names of senders and receivers."""
    sides = [
        tracker_raw.filter(F.col(c) != NOT_A_NAME).select(F.trim(c).alias("po_name")) for c in ("ship_to", "ship_from")
    ]
    return sides[0].union(sides[1]).distinct()


def vendor_mapping(tracker_raw: DataFrame, vendors: DataFrame, min_sim: int = 85) -> DataFrame:
    """The most similar vendors per ship name: equally similar ones are all kept
    and numbered, names without a match stay with NULLs."""
    found = fuzzy_best_match(
        ship_names(tracker_raw), vendors.select("display_name", "print_on_check_name", "id"), "po_name",
        "display_name", min_sim, exclude=DELETED_VENDOR, keep_ties=True,
    )
    return found.select(
        "po_name",
        F.col("display_name").alias("qb_name"),
        F.col("print_on_check_name").alias("qb_check_name"),
        "id",
        F.col("po_name").alias("tc_name"),
        "similarity",
        "row_num",
    )


def po_tracker(raw: DataFrame, sku: DataFrame, vendor_map: DataFrame, status: DataFrame) -> DataFrame:
    """PO lines with item, vendor and status attributes; ``latest`` marks lines of
    the newest sync minute. Of equally similar vendors the first one counts."""
    minute = F.date_trunc("minute", F.col("_fivetran_synced"))
    t = attach_max(raw, minute, "_newest")
    items = sku.groupBy("sku").agg(
        F.min(F.struct("sku_name", "sku_type", "upc")).alias("_item")
    ).select(F.col("sku"), F.col("_item.sku_name"), F.col("_item.sku_type"), F.col("_item.upc"))
    t = enrich(t, items, "sku", "sku", {"sku_type": "po_type", "sku_name": "sku_name", "upc": "upc"})
    chosen = vendor_map.filter("row_num = 1").select("po_name", "id")
    t = enrich_roles(t, chosen, "po_name", {"ship_from": {"id": "ship_from_id"}, "ship_to": {"id": "ship_to_id"}})
    t = enrich(t, status.withColumnRenamed("status", "_s"), "status", "_s", {"type": "status_type"})
    received = F.col("quantity_received")
    return t.select(
        "master_po_num", "status", "status_type", "brand", "po_type",
        F.trim("fg_po_association").alias("fg_po_association"),
        "po_date",
        F.trim("vendor_sku").alias("vendor_sku"),
        "sku", "sku_name", "upc", "max_lead_time",
        serial_date(F.col("ship_date_lead_time")).alias("ship_date_lead_time"),
        *[
            leading_date(F.col(c)).alias(c)
            for c in ("ship_date_req", "ship_date_actual", "req_receipt_date", "delivery_date_actual", "invoice_due_date")
        ],
        "ship_from", "ship_from_id", "ship_to", "ship_to_id", "total_po_quantity_sku", "quantity",
        "quantity_received", "moq",
        F.round("price_per_unit", 2).alias("per_unit_order"),
        F.when(F.col("status") == COMPLETE, ratio(F.col("total"), received, 2)).alias("per_unit_effective"),
        F.round("total", 2).alias("total"),
        *TERMS,
        leading_date(F.col("launch_date")).alias("launch_date"),
        flag(minute == F.col("_newest")).alias("latest"),
        sync_line_id().alias("_row_id"),
        "_line", "_fivetran_synced",
    )


def tracker_clean(tracker: DataFrame, kind: str = "all") -> DataFrame:
    """Latest lines: ``all``, ``complete`` or ``open``."""
    out = tracker.filter("latest")
    if kind == "complete":
        out = out.filter(F.col("status") == COMPLETE)
    elif kind == "open":
        out = out.filter(F.col("status_type") == "OPEN")
    return out.select(*CLEAN_COLUMNS)


def purchases(tracker: DataFrame) -> DataFrame:
    """Latest complete lines, added up per purchase."""
    done = tracker.filter("latest").filter(F.col("status") == COMPLETE)
    out = done.groupBy(
        "master_po_num", "sku", F.col("per_unit_order").alias("per_unit"), "status",
        F.col("delivery_date_actual").alias("delivery_date"), F.col("ship_date_actual").alias("ship_date"),
        "po_date", "_fivetran_synced",
    ).agg(
        F.round(F.sum(F.col("total").cast(MONEY)), 2).alias("total_purchase_cost"),
        F.sum("quantity").alias("total_ordered"),
        F.sum("quantity_received").alias("total_received"),
    )
    return out.withColumns(
        {
            "received_delta": F.col("total_received") - F.col("total_ordered"),
            "purchase_date": F.coalesce("delivery_date", "ship_date", "po_date"),
            "last_updated": F.col("_fivetran_synced").cast("date"),
        }
    ).drop("_fivetran_synced")


def average_price(tracker: DataFrame, sku: DataFrame, brands: DataFrame) -> DataFrame:
    """Average purchase price per SKU: on ordered units, on received units, and
    the plain mean of unit prices; the first of received, ordered, mean wins."""
    per_sku = purchases(tracker).groupBy("sku").agg(
        F.sum("total_purchase_cost").alias("_cost"),
        F.sum("total_ordered").alias("_ordered"),
        F.sum("total_received").alias("_received"),
        F.sum(F.col("per_unit").cast(MONEY)).alias("_unit_sum"),
        F.count("per_unit").alias("_unit_n"),
        F.max("last_updated").alias("last_updated"),
    )
    prices = per_sku.select(
        F.col("sku").alias("_sku"),
        ratio(F.col("_cost"), F.col("_ordered"), 2).alias("average_price_order"),
        ratio(F.col("_cost"), F.col("_received"), 2).alias("average_price_effective"),
        F.coalesce(ratio(F.col("_unit_sum"), F.col("_unit_n"), 2), F.lit(0.0)).alias("average_per_unit"),
        "last_updated",
    ).filter(F.col("last_updated").isNotNull())
    names = brands.select("brand_id", F.col("brand_name").alias("_brand"))
    joined = sku.join(prices, F.col("sku") == F.col("_sku"), "inner").join(
        names, F.col("brand") == F.col("brand_id"), "left"
    )
    return joined.select(
        "sku", "sku_name", F.col("sku_type").alias("product_type"), "upc", F.col("_brand").alias("brand"), "status",
        "vendor", "vendor_id", "average_price_order", "average_price_effective", "average_per_unit",
        F.round(F.col("average_price_effective") - F.col("average_price_order"), 2).alias("order_effective_delta"),
        F.coalesce("average_price_effective", "average_price_order", "average_per_unit").alias("average_price"),
        F.lit(None).cast("date").alias("price_effective_from"),
        F.lit(None).cast("date").alias("price_effective_to"),
        "last_updated",
        F.lit(True).alias("latest"),
    )


def average_price_summary(prices: DataFrame, finished_only: bool = False, active_only: bool = False) -> DataFrame:
    """Latest prices; the four summary views are the four flag combinations."""
    out = prices.filter("latest")
    if finished_only:
        out = out.filter(F.col("product_type") == "Finished Good")
    if active_only:
        out = out.filter(F.col("status") == "Active")
    return out.select("sku", "sku_name", "product_type", "upc", "status", "average_price")


def running_inventory_cost(bought: DataFrame) -> DataFrame:
    """Every purchase with the SKU's average cost up to and including its PO date.

    The running sums count all purchases of the same day. They are taken over
    days per SKU and joined back, so a hot SKU is summed map-side first. Purchases
    are written once and read twice.
    """
    bought = materialise(bought, "purchases")
    received = F.coalesce("total_received", "total_ordered")
    running = running_by_day(
        bought, ["sku"], "po_date",
        {"_cost": F.col("total_purchase_cost"), "_ordered": F.col("total_ordered"), "_received": received},
    ).select(F.col("sku").alias("_sku"), F.col("po_date").alias("_day"), "_cost", "_ordered", "_received")
    joined = bought.join(
        running, F.col("sku").eqNullSafe(F.col("_sku")) & F.col("po_date").eqNullSafe(F.col("_day")), "inner"
    )
    return joined.select(
        "master_po_num", "sku", "total_purchase_cost", "total_ordered", "total_received",
        F.coalesce("po_date", "ship_date", "delivery_date").alias("po_date"),
        ratio(F.col("_cost"), F.col("_ordered"), 2).alias("average_inventory_cost_at_po_date"),
        "delivery_date",
        ratio(F.col("_cost"), F.col("_received"), 2).alias("adjusted_average_cost_based_on_received"),
        ratio(F.col("total_purchase_cost"), received, 2).alias("average_effective_price"),
    )


def cumulative_purchases(inventory_history: DataFrame, costed: DataFrame) -> DataFrame:
    """Cumulative purchases per SKU on every inventory day, and weighted average
    prices. ``costed`` is :func:`running_inventory_cost`.

    One row per inventory day and SKU. Purchases are summed per SKU and day
    before they meet the inventory days; a SKU held in several warehouses counts
    its purchases once per warehouse row, as the original join does.
    """
    gap = F.col("total_purchase_cost").cast("decimal(24,6)") - (
        F.coalesce("total_received", "total_ordered").cast("decimal(18,4)")
        * F.col("adjusted_average_cost_based_on_received").cast("decimal(18,2)")
    ).cast("decimal(24,6)")
    daily = costed.groupBy(F.col("sku").alias("_sku"), F.col("po_date").alias("_day")).agg(
        F.sum("total_purchase_cost").alias("_cost"),
        F.sum("total_ordered").alias("_units"),
        F.sum("total_received").alias("_received"),
        F.sum(gap).alias("_gap"),
    )
    held = inventory_history.groupBy("date", "sku").agg(F.count(F.lit(1)).alias("_rows"))
    joined = held.join(daily, (F.col("sku") == F.col("_sku")) & (F.col("date") == F.col("_day")), "left")
    out = running_sums(
        joined, ["sku"], ["date"],
        {
            "cumulative_total_purchase_cost_by_sku": F.col("_cost") * F.col("_rows"),
            "cumulative_total_purchased_units_by_sku": F.col("_units") * F.col("_rows"),
            "cumulative_total_received_units_by_sku": F.col("_received") * F.col("_rows"),
            "_gap_so_far": "_gap",
        },
    )
    cost, units = F.col("cumulative_total_purchase_cost_by_sku"), F.col("cumulative_total_purchased_units_by_sku")
    return out.select(
        "date",
        "sku",
        cost.cast("double").alias("cumulative_total_purchase_cost_by_sku"),
        units.alias("cumulative_total_purchased_units_by_sku"),
        "cumulative_total_received_units_by_sku",
        ratio(cost, units).alias("weighted_avg_order_price_based_on_pos"),
        ratio(cost - F.col("_gap_so_far"), units).alias("weighted_avg_order_price_based_on_received"),
    )


def price_timeline(bought: DataFrame) -> DataFrame:
    """Average prices per SKU from each purchase date until the next one."""
    sums = {
        "_cost": F.col("total_purchase_cost"),
        "total_ordered": F.col("total_ordered"),
        "total_received": F.col("total_received"),
        "_unit_sum": F.col("per_unit").cast(MONEY),
        "_unit_n": F.when(F.col("per_unit").isNotNull(), 1).otherwise(0),
    }
    daily = bought.groupBy("sku", "purchase_date").agg(
        *[F.sum(v).alias(n) for n, v in sums.items()], F.max("last_updated").alias("_updated")
    )
    daily = running_sums(daily, ["sku"], ["purchase_date"], {n: n for n in sums})
    per_sku = Window.partitionBy("sku").orderBy("purchase_date")
    return daily.select(
        "sku",
        F.col("purchase_date").alias("effective_from"),
        F.lead("purchase_date").over(per_sku).alias("effective_to"),
        F.col("_cost").cast("double").alias("total_cost"),
        "total_ordered",
        "total_received",
        ratio(F.col("_cost"), F.col("total_ordered"), 2).alias("average_po_price_order"),
        ratio(F.col("_cost"), F.col("total_received"), 2).alias("average_po_price_effective"),
        ratio(F.col("_unit_sum"), F.col("_unit_n")).alias("average_per_unit"),
        F.max("_updated").over(per_sku.rowsBetween(Window.unboundedPreceding, 0)).alias("last_updated"),
    )
