"""Bills of material: enrichment, usage checks, component matrix, cost."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from opsmart.operators.match import enrich_roles
from opsmart.operators.metrics import count_if, presence_matrix
from opsmart.operators.ranking import sequence_in_group

FINISHED = "Finished Good"

# Component type codes of the matrix, {column: code}.
COMPONENT_TYPES = {
    "product_fill": "FILL", "bulk": "BULK", "label": "LAB", "bag": "BAG", "packaging_box": "BOX",
    "bottle_cap": "BTCP", "bottle": "BTL", "bottle_nozzle": "BTNZ", "bottle_pipette": "BTPI",
    "bottle_treatment_pump": "BTPM", "bottle_trigger_pump": "BTTG", "cap": "CAP", "chipper": "CHI",
    "clip": "CLP", "comb": "CMB", "fragrance": "FRG", "headband": "HDB", "insert": "INS", "jar": "JAR",
    "labor": "LABOR", "pump": "PUM", "pump_sprayer": "PUS", "scrunchie": "SCR", "shipper": "SHI",
    "tube": "TBE", "tub": "TUB", "towel": "TWL", "unit_carton": "UNC", "upc_label": "UPC",
}


def bom_enrich(raw: DataFrame, sku: DataFrame) -> DataFrame:
    """BOM lines with the master data of the component and of the finished good,
    numbered inside the finished good by component (then by line)."""
    return bom_lines(sequence_in_group(raw, ["fg_sku"], ["component_sku", "_line"], "component_index"), sku)


def bom_lines(raw: DataFrame, sku: DataFrame) -> DataFrame:
    """BOM lines with master data; with their numbers if ``raw`` has them. Reports that show no
    number take the lines as they are."""
    number = ["component_index"] if "component_index" in raw.columns else []
    joined = enrich_roles(
        raw,
        sku,
        "sku",
        {
            "component_sku": {
                "sku_name": "component_name", "sku_type": "_type", "product_group": "component_type",
                "version": "component_version", "unit": "component_unit", "vendor": "component_vendor",
                "vendor_id": "component_vendor_id",
            },
            "fg_sku": {
                "sku_name": "fg_sku_name", "upc": "fg_upc", "product_code": "fg_product_code",
                "product_group": "fg_product_group", "vendor": "fg_manufacturer", "status": "fg_status",
            },
        },
    )
    return joined.select(
        "component_sku", "component_name",
        F.coalesce(F.col("_type") == FINISHED, F.lit(False)).alias("is_fg"),
        "usage", "fg_sku", "fg_sku_name", "fg_upc", "fg_product_code", "fg_product_group", "fg_manufacturer",
        "fg_status", *number, "component_type", "component_version", "component_unit",
        "component_vendor", "component_vendor_id",
        (F.col("_line") + 1).alias("index"),
        F.lit(True).alias("latest"),
        "_fivetran_synced",
    )


def boms_by_sku(boms: DataFrame) -> DataFrame:
    """Latest lines under the finished good's names."""
    return boms.filter("latest").select(
        F.col("fg_sku").alias("sku"), F.col("fg_sku_name").alias("sku_name"), F.col("fg_upc").alias("upc"),
        "component_sku", "component_name", "component_index", "is_fg", "usage", "component_type",
        "component_version", "component_unit", "component_vendor", "component_vendor_id",
    )


def bom_usage_summary(boms: DataFrame, only_missing: bool = False) -> DataFrame:
    """Components per finished good, and how many lack a usage figure."""
    out = boms.filter("latest").groupBy(
        F.col("fg_sku").alias("sku"), F.col("fg_sku_name").alias("sku_name"), F.col("fg_upc").alias("upc")
    ).agg(
        F.count(F.lit(1)).alias("num_components"), count_if(F.col("usage").isNull()).alias("num_missing_usage")
    )
    return out.filter("num_missing_usage > 0") if only_missing else out


def component_matrix(boms: DataFrame, groups: DataFrame, types: dict[str, str] = COMPONENT_TYPES) -> DataFrame:
    """One row per finished good with a flag per component type. Components of an
    unknown type are left out, and so is a product that has no other kind."""
    known = boms.join(groups.select(F.col("group_id").alias("component_type")).distinct(), "component_type", "left_semi")
    named = known.select(F.col("fg_sku").alias("sku"), F.col("fg_sku_name").alias("sku_name"), "component_type")
    return presence_matrix(named, ["sku", "sku_name"], "component_type", types)


def component_type_matches(boms: DataFrame, groups: DataFrame) -> DataFrame:
    """Component types in use and the product group they match, if any."""
    used = boms.select("component_type").distinct()
    ids = groups.select(F.col("group_id").alias("product_type")).distinct()
    return used.join(ids, F.col("component_type") == F.col("product_type"), "left")


def bom_cost(boms: DataFrame, average_price: DataFrame, sku: DataFrame, weight_by_usage: bool = False) -> DataFrame:
    """Cost of every active finished good: the sum of its distinct components'
    average prices, optionally weighted by usage."""
    lines = ["component_sku", "component_name", "fg_sku", "fg_sku_name"]
    used = boms.select(*lines, *(["usage"] if weight_by_usage else [])).distinct()
    prices = average_price.select(F.col("sku").alias("component_sku"), "average_price")
    priced = used.join(prices, "component_sku", "left")
    if not weight_by_usage:
        priced = priced.distinct()
    amount = F.col("average_price").cast("decimal(18,6)")
    if weight_by_usage:
        amount = amount * F.coalesce(F.col("usage"), F.lit(1.0)).cast("decimal(18,6)")
    totals = priced.groupBy(F.col("fg_sku").alias("sku")).agg(F.sum(amount).cast("double").alias("total_cost"))
    goods = sku.filter((F.col("sku_type") == FINISHED) & (F.col("status") == "Active"))
    return goods.join(totals, "sku", "left").select(
        "sku", F.col("sku_name").alias("name"), "upc", "product_code", "product_group", "status", "total_cost"
    )


def component_vendor_sku(boms: DataFrame, sku: DataFrame) -> DataFrame:
    """The vendor's own number for each component."""
    return enrich_roles(boms.select("component_sku"), sku, "sku", {"component_sku": {"vendor_sku": "vendor_sku"}})
