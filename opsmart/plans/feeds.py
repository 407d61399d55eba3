"""Warehouse and third-party-logistics feeds: raw report rows to typed rows.

Each ``parse_*`` is one projection; loading is
:func:`opsmart.operators.load.incremental_load` or ``TableStore.load`` with
the policy named in :data:`POLICY`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from opsmart.functions import sku as S
from opsmart.functions.dates import is_month_end, parse_slash_date, parse_us_timestamp, report_date
from opsmart.functions.keys import file_line_id
from opsmart.functions.numbers import parse_amount, parse_count, parse_int, parse_wide_integer
from opsmart.functions.text import is_cancelled, without_cancel_mark
from opsmart.operators.match import first_per_key
from opsmart.operators.ranking import sequence_in_group

#: Load policy of each feed, and the column it orders by.
POLICY = {
    "wms_inventory": ("flip_if_new", None),
    "wms_inventory_history": ("max_of_batch", "_modified"),
    "wms_transaction_lines": ("flip_matched", None),
    "wms_transaction_register": ("flip_if_new", None),
    "3pl_inventory": ("max_of_batch", "report_date"),
    "3pl_shipment": ("max_of_batch", "report_date"),
    "edi_register": ("flip_matched", None),
    "edi_integration": ("flip_if_new", None),
}

# A UPC that stands for "none", and the first register day kept.
NO_UPC = "000000000000"
REGISTER_SINCE = "2020-01-01"

def _with_lineage(*columns: Column | str) -> list:
    return [*columns, file_line_id().alias("_row_id"), "_modified", "_file", "_fivetran_synced"]


def parse_inventory(raw: DataFrame) -> DataFrame:
    """Current-stock report. Report column names are positional on the left."""
    sku, run = F.col("sku"), parse_us_timestamp(F.col("end_date")).cast("date")
    return raw.filter(F.col("customer").isNotNull()).select(
        *_with_lineage(
            sku.alias("hdc_sku"),
            S.clean_sku_current(sku).alias("sku"),
            S.upc_current(sku).alias("upc"),
            S.is_misc_supply(sku).alias("misc_supply"),
            F.col("item_description").alias("sku_name"),
            "warehouse",
            S.location_current(sku).alias("warehouse_location"),
            F.col("customer").alias("brand_name"),
            parse_count(F.col("detail_on_hand")).alias("on_hand"),
            parse_count(F.col("textbox_39")).alias("on_hold"),
            parse_count(F.col("detail_available")).alias("available"),
            F.col("textbox_15").alias("uom"),
            F.col("textbox_18").alias("dimension_units"),
            F.col("textbox_42").alias("weight_units"),
            parse_amount(F.col("detail_cartons")).alias("dim_quantity"),
            F.col("textbox_28").alias("dim_uom"),
            parse_count(F.col("detail_packed")).alias("packed"),
            parse_amount(F.col("detail_cu_ft")).alias("cu_ft"),
            parse_amount(F.col("detail_weight")).alias("weight"),
            run.alias("inv_run"),
            is_month_end(run).alias("month_end"),
            F.last_day(run).alias("month_end_date"),
            F.lit(True).alias("latest"),
        )
    )


def parse_inventory_history(raw: DataFrame, brand: str) -> DataFrame:
    """Stock-history report; the warehouse header also carries the run date."""
    sku, item, run = F.col("sku"), F.col("item_description"), S.header_run_date(F.col("warehouse"))
    return raw.filter(F.col("customer").isNotNull()).select(
        *_with_lineage(
            sku.alias("hdc_sku"),
            S.clean_sku_history(sku).alias("sku"),
            S.upc_history(sku).alias("upc"),
            S.is_misc_supply(sku).alias("misc_supply"),
            S.item_name(item).alias("sku_name"),
            S.warehouse_name(F.col("warehouse")).alias("warehouse"),
            S.location_history(sku, F.col("qualifier"), item).alias("warehouse_location"),
            F.lit(brand).alias("brand_name"),
            parse_count(F.col("detail_on_hand")).alias("on_hand"),
            parse_count(F.col("detail_quarantine_on_hold")).alias("on_hold"),
            parse_count(F.col("detail_available")).alias("available"),
            F.col("detail_primary_uom").alias("uom"),
            F.col("volume_unit").alias("dimension_units"),
            F.col("weight_unit").alias("weight_units"),
            parse_amount(F.col("detail_cartons")).alias("dim_quantity"),
            F.col("detail_dim_uom").alias("dim_uom"),
            parse_count(F.col("detail_packed")).alias("packed"),
            parse_amount(F.col("detail_cu_ft")).alias("cu_ft"),
            parse_amount(F.col("detail_weight")).alias("weight"),
            run.alias("inv_run"),
            is_month_end(run).alias("month_end"),
            F.last_day(run).alias("month_end_date"),
        )
    )


def parse_transaction_lines(raw: DataFrame) -> DataFrame:
    """Order lines, numbered from 0 inside their transaction by raw SKU (then
    file and line). The report shifts its columns: ``qty_in`` holds the
    transaction id, ``tracking_number`` the PO number, ``materials`` the quantity.
    """
    kept = raw.filter(F.col("qty_in").isNotNull())
    numbered = sequence_in_group(kept, ["qty_in"], ["textbox_12", "_file", "_line"], "index", start=0)
    return numbered.select(
        *_with_lineage(
            F.col("qty_in").alias("transaction_id"),
            "index",
            F.col("name").alias("brand_name"),
            parse_slash_date(without_cancel_mark(F.col("ship_date"))).alias("ship_date"),
            F.col("textbox_15").alias("carrier"),
            F.col("transaction_id").alias("customer_ref"),
            parse_wide_integer(F.col("textbox_14")).cast("string").alias("tracking_num"),
            F.col("tracking_number").alias("po_number"),
            S.clean_sku_line(F.col("textbox_12")).alias("sku"),
            F.col("textbox_67").alias("warehouse"),
            parse_int(F.col("materials")).alias("quantity"),
            F.lit(True).alias("latest"),
        )
    )


def nth_po_number(lines: DataFrame, n: int = 2) -> DataFrame:
    """The ``n``-th PO number of each transaction, counted over the lines that
    have one, in index order. Each map task keeps ``n`` rows per transaction."""
    with_po = lines.filter(F.col("po_number").isNotNull()).select("transaction_id", "index", "po_number", "_row_id")
    ranked = first_per_key(with_po, ["transaction_id"], ["index", "_row_id"], n, rank="_place")
    return ranked.filter(F.col("_place") == n).select("transaction_id", "po_number")


def parse_transaction_register(raw: DataFrame, lines: DataFrame, since: str = REGISTER_SINCE) -> DataFrame:
    """Transactions with both dates on or after ``since``; a transaction whose
    lines carry a second PO number is retail. One row per raw line."""
    dated = raw.filter(F.col("transaction_id").isNotNull()).withColumns(
        {
            "_day": parse_slash_date(F.col("date").cast("string")),
            "_shipped": parse_slash_date(without_cancel_mark(F.col("ship_date"))),
        }
    )
    start = F.lit(since).cast("date")
    dated = dated.filter((F.col("_day") >= start) & (F.col("_shipped") >= start))
    po = nth_po_number(lines).select(F.col("transaction_id").alias("_id"), "po_number")
    joined = dated.join(po, F.col("transaction_id") == F.col("_id"), "left")
    return joined.select(
        *_with_lineage(
            F.col("transaction_id").alias("id"),
            F.col("name").alias("brand_name"),
            F.col("_day").alias("transaction_date"),
            "po_number",
            F.trunc("_day", "month").alias("period_first_day"),
            F.last_day("_day").alias("period_last_day"),
            F.col("_shipped").alias("ship_date"),
            is_cancelled(F.col("ship_date")).alias("cancelled"),
            "carrier",
            F.col("customer_ref_").alias("customer_ref"),
            F.col("po_number").isNotNull().alias("retail"),
            F.col("tracking_number").alias("tracking_num"),
            F.col("ship_to_company").alias("shipping_recipient"),
            parse_int(F.col("qty_in")).alias("quantity_in"),
            parse_int(F.col("qty_out")).alias("quantity_out"),
            F.col("handling").try_cast("double").alias("charge_handling"),
            F.col("materials").try_cast("double").alias("charge_materials"),
            F.col("storage").try_cast("double").alias("charge_storage"),
            F.col("special").try_cast("double").alias("charge_special"),
            F.col("freight_pp").try_cast("double").alias("charge_freight"),
            F.col("total").try_cast("double").alias("charge_total"),
            "notes",
            F.lit(True).alias("latest"),
        )
    )


def parse_3pl_inventory(raw: DataFrame, file_prefix: str) -> DataFrame:
    """Stock of the second warehouse; the report date is in the file name."""
    return raw.select(
        *_with_lineage(
            report_date(F.col("_file"), file_prefix).alias("report_date"),
            F.col("_line").alias("index"),
            F.col("product_code").alias("sku"),
            F.col("product_description").alias("sku_name"),
            F.col("product_description_2").alias("sku_description"),
            F.nullif(F.col("upc_code"), F.lit(NO_UPC)).alias("upc"),
            F.col("quantity_on_hand").try_cast("bigint").alias("quantity_on_hand"),
            F.col("quantity_allocated").try_cast("bigint").alias("quantity_allocated"),
            F.col("available_inv_oh").try_cast("bigint").alias("quantity_available"),
            F.col("unit_case_eaches_carton").try_cast("bigint").alias("eaches_per_carton"),
        )
    )


def parse_3pl_shipment(raw: DataFrame, file_prefix: str) -> DataFrame:
    return raw.select(
        *_with_lineage(
            report_date(F.col("_file"), file_prefix).alias("report_date"),
            F.col("_line").alias("index"),
            F.col("shipment_date").try_cast("date").alias("ship_date"),
            F.col("shipment_").alias("ship_id"),
            F.col("ship_to_state").alias("ship_state"),
            F.col("primary_ref_").alias("reference"),
            F.col("primary_ref_po_").alias("po_number"),
            F.col("bill_to_contact").alias("bill_contact"),
            F.col("scac").alias("carrier"),
            F.col("scac_description").alias("carrier_description"),
            F.col("unit_price").try_cast("double").alias("unit_price"),
            F.col("bol_pro_").alias("warehouse_ref"),
        )
    )


def target_reasons(raw: DataFrame) -> DataFrame:
    """Dispute reason codes with their padding trimmed."""
    return raw.select(
        F.col("_line").cast("string").alias("id"),
        F.trim("team_area").alias("team_area"),
        F.trim("reason_code_category").alias("reason_code_category"),
        F.trim("reason_codes").alias("reason_code"),
        F.trim("category").alias("category"),
        "description",
        "how_to_dispute",
    )

