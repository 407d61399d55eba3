"""Schemas of the curated tables, keyed by table name.

Integers are 64-bit, money columns of source reports are doubles, and time
stamps are stored in UTC with microseconds.
"""

from __future__ import annotations

from pyspark.sql import types as T

_LINEAGE = "_row_id string, _modified timestamp, _file string, _fivetran_synced timestamp"

_STOCK = (
    "hdc_sku string, sku string, upc string, misc_supply boolean, sku_name string, warehouse string, "
    "warehouse_location string, brand_name string, on_hand bigint, on_hold bigint, available bigint, uom string, "
    "dimension_units string, weight_units string, dim_quantity double, dim_uom string, packed bigint, cu_ft double, "
    "weight double, inv_run date, month_end boolean, month_end_date date"
)

# Names and types of the curated columns.
DDL = {
    "audience": "id string, email string, first_name string, last_name string, city string, zip string, "
    "country string, country_code string, phone string",
    "audience_export": "email string, first_name string, last_name string, zip string, country string, phone string",
    "boms": "component_sku string, component_name string, is_fg boolean, usage double, fg_sku string, "
    "fg_sku_name string, fg_upc string, fg_product_code string, fg_product_group string, fg_manufacturer string, "
    "fg_status string, component_index bigint, component_type string, component_version string, "
    "component_unit string, component_vendor string, component_vendor_id string, index bigint, latest boolean, "
    "_fivetran_synced timestamp",
    "bom_sku": "sku string, name string, upc string, product_code string, product_group string, status string, "
    "total_cost double, latest boolean, last_updated timestamp",
    "wms_transaction_register": "id string, brand_name string, transaction_date date, po_number string, "
    "period_first_day date, period_last_day date, ship_date date, cancelled boolean, carrier string, "
    "customer_ref string, retail boolean, tracking_num string, shipping_recipient string, quantity_in bigint, "
    "quantity_out bigint, charge_handling double, charge_materials double, charge_storage double, "
    "charge_special double, charge_freight double, charge_total double, notes string, latest boolean, " + _LINEAGE,
    "wms_transaction_lines": "transaction_id string, index bigint, brand_name string, ship_date date, "
    "carrier string, customer_ref string, tracking_num string, po_number string, sku string, warehouse string, "
    "quantity bigint, latest boolean, " + _LINEAGE,
    "wms_inventory": f"{_STOCK}, latest boolean, {_LINEAGE}",
    "wms_inventory_history": f"{_STOCK}, latest boolean, {_LINEAGE}",
    "3pl_inventory": "report_date date, latest boolean, index bigint, sku string, sku_name string, "
    "sku_description string, upc string, quantity_on_hand bigint, quantity_allocated bigint, "
    "quantity_available bigint, eaches_per_carton bigint, " + _LINEAGE,
    "3pl_shipment": "report_date date, latest boolean, index bigint, ship_date date, ship_id string, "
    "ship_state string, reference string, po_number string, bill_contact string, carrier string, "
    "carrier_description string, unit_price double, warehouse_ref string, " + _LINEAGE,
    "invoice_estimate_ref": "invoice_id string, qb_invoice_id string, estimate_id string, qb_estimate_id string, "
    "customer string, customer_id string",
    "inventory_history": "sku string, sku_name string, upc string, product_type string, status string, "
    "warehouse string, date date, total_on_hand bigint, total_on_hold bigint, total_available bigint, "
    "month_end boolean, _row_id string",
    "warehouse_map": "warehouse_sku string, sku_ref string",
    "vendor_mapping": "po_name string, qb_name string, qb_check_name string, id string, tc_name string, "
    "similarity int, row_num int",
    "po_tracker": "master_po_num string, status string, status_type string, brand string, po_type string, "
    "fg_po_association string, po_date date, vendor_sku string, sku string, sku_name string, upc string, "
    "max_lead_time double, ship_date_lead_time date, ship_date_req date, ship_date_actual date, "
    "req_receipt_date date, delivery_date_actual date, invoice_due_date date, ship_from string, "
    "ship_from_id string, ship_to string, ship_to_id string, total_po_quantity_sku double, quantity double, "
    "quantity_received double, moq double, per_unit_order double, per_unit_effective double, total double, "
    "payment_terms string, pmt_upfront_percent double, pmt_upfront_net bigint, pmt_upfront_addl_percent double, "
    "pmt_upfront_addl_net bigint, pmt_ship_percent double, pmt_ship_net bigint, pmt_delivery_percent double, "
    "pmt_delivery_net bigint, pmt_cc boolean, pmt_cc_percent double, pmt_check boolean, new_launch boolean, "
    "launch_date date, latest boolean, _row_id string, _line bigint, _fivetran_synced timestamp",
    "average_price": "sku string, sku_name string, product_type string, upc string, brand string, status string, "
    "vendor string, vendor_id string, average_price_order double, average_price_effective double, "
    "average_per_unit double, order_effective_delta double, average_price double, price_effective_from date, "
    "price_effective_to date, last_updated date, latest boolean",
    "po_status": "status string, type string",
    "target_reasons": "id string, team_area string, reason_code_category string, reason_code string, "
    "category string, description string, how_to_dispute string",
    "groups": "group_id string, group_name string, product_type string",
    "brands": "brand_id string, brand_name string",
    "sku_master": "sku string, sku_name string, upc string, brand string, status string, product_code string, "
    "product_group string, sku_type string, class string, version string, vendor string, vendor_id string, "
    "country string, dimensions_units string, weight_units string, unit string, unit_width double, "
    "unit_height double, unit_length double, carton_height double, carton_width double, carton_length double, "
    "carton_weight double, eaches_per_carton bigint, notes string, _fivetran_synced timestamp",
    "retail_master": "sku string, retailer string, retailer_sku string, upc string, srp double, "
    "retail_discount double, retail_srp double",
    "edi_register": "transaction_id string, index bigint, trading_partner string, trading_partner_qb_id string, "
    "transaction_type string, transaction_type_id string, doc_number string, alt_doc_number string, amount double, "
    "creation_date date, folder string, action_date date, action_name string, action_status string, "
    "period_first_day date, period_last_day date, latest boolean, " + _LINEAGE,
    "edi_integration": "transaction_id string, index bigint, trading_partner string, trading_partner_qb_id string, "
    "transaction_type string, alt_doc_number string, tc_account_id string, amount double, document_date timestamp, "
    "log_time timestamp, description string, period_first_day date, period_last_day date, latest boolean, " + _LINEAGE,
    "edi_partner_mapping": "qb_id string, qb_name string, qb_fq_name string, tc_name string",
    "last_updated": "schema_name string, table_name string, last_updated timestamp",
}


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(DDL[table])
