"""SKU reference data."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from opsmart.operators.fuzzy import fuzzy_best_match
from opsmart.sources.tables import rename

# Fixed value: pattern of vendor names that are no longer in use.
DELETED_VENDOR = "%(deleted)%"

# Columns taken over unchanged from the raw master.
MASTER_COLUMNS = [
    "sku", "sku_name", "upc", "brand", "status", "product_code", "product_group", "sku_type", "class", "version",
    "vendor",
]
MASTER_TAIL = [
    "country", "dimensions_units", "weight_units", "unit", "unit_width", "unit_height", "unit_length",
    "carton_height", "carton_width", "carton_length", "carton_weight",
]


def vendor_ids(names: DataFrame, column: str, vendors: DataFrame, min_sim: int = 85) -> DataFrame:
    """Distinct names and the id of the most similar live vendor, if any."""
    return fuzzy_best_match(
        names, vendors.select("display_name", "id"), column, "display_name", min_sim, exclude=DELETED_VENDOR,
        keep_unmatched=False,
    ).select(column, F.col("id").alias("vendor_id"))


def sku_master(raw: DataFrame, vendors: DataFrame, min_sim: int = 85) -> DataFrame:
    """The SKU master with vendor ids found by name. Matching runs over distinct
    vendor names, never over SKUs."""
    ids = vendor_ids(raw, "vendor", vendors, min_sim)
    return raw.join(ids, "vendor", "left").select(
        *MASTER_COLUMNS,
        "vendor_id",
        *MASTER_TAIL,
        F.col("eaches_per_carton").try_cast("bigint").alias("eaches_per_carton"),
        "notes",
        "_fivetran_synced",
    )


def retail_master(raw: DataFrame) -> DataFrame:
    """What each retailer calls our SKUs, and its prices."""
    same = ["retailer", "retailer_sku", "upc", "srp", "retail_discount", "retail_srp"]
    return rename(raw, {"sku_sold_to_retailer": "sku", **{c: c for c in same}})


def product_groups(raw: DataFrame) -> DataFrame:
    return raw.select("group_id", "group_name", "product_type")


def finished_goods(master: DataFrame) -> DataFrame:
    return master.filter(F.col("sku_type") == "Finished Good")
