"""Edge rows of every business area, on literal fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from opsmart.functions.keys import file_line_id
from opsmart.operators.series import date_spine
from opsmart.operators.load import LoadStats
from opsmart.plans import ads, audience, bom, edi, feeds, finance, funnel, inventory, purchasing, refresh, sales, shop, sku
from opsmart.schemas import schema
from opsmart.sources.store import TableStore
from opsmart.sources.tables import typed

D, TS = dt.date, dt.datetime
T0 = TS(2023, 4, 1, 3, 0, 10)


def make(spark, rows, ddl):
    """Frame of dict rows; columns a row leaves out are NULL."""
    from pyspark.sql import types as T

    st = T.StructType.fromDDL(ddl)
    return spark.createDataFrame([tuple(r.get(n) for n in st.names) for r in rows], st)


def by(df, *key):
    out = {}
    for r in df.collect():
        k = tuple(r[c] for c in key)
        assert (k if len(k) > 1 else k[0]) not in out, "rows are not unique on the key"
        out[k if len(k) > 1 else k[0]] = r
    return out


LINEAGE = ", _file string, _line bigint, _modified timestamp, _fivetran_synced timestamp"


def lined(rows, file="f.csv"):
    return [{"_file": file, "_line": i, "_modified": T0, "_fivetran_synced": T0, **r} for i, r in enumerate(rows)]


# ---- warehouse feeds ---------------------------------------------------------

INVENTORY = ("customer string, sku string, item_description string, warehouse string, detail_on_hand string, textbox_39 string, "
             "detail_available string, textbox_15 string, textbox_18 string, textbox_42 string, detail_cartons string, textbox_28 string, "
             "detail_packed string, detail_cu_ft string, detail_weight string, end_date string" + LINEAGE)


def test_inventory(spark):
    rows = lined([
        {"customer": None, "sku": "X"},
        {"customer": "C", "sku": ".ABC-DELETE", "detail_on_hand": "1,234", "textbox_39": "abc", "end_date": "03/31/2023 11:59:00 PM"},
        {"customer": "C", "sku": "ABC SKU#:A12-34/0123", "end_date": "bad"},
        {"customer": "C", "sku": "MISC SUPPLY x", "end_date": "2/1/2023 1:00:00 AM"},
    ])
    out = by(feeds.parse_inventory(make(spark, rows, INVENTORY)), "hdc_sku")
    assert len(out) == 3
    r = out[".ABC-DELETE"]
    assert (r.sku, r.on_hand, r.on_hold, r.inv_run, r.month_end, r.latest) == ("ABC", 1234, None, D(2023, 3, 31), True, True)
    r = out["ABC SKU#:A12-34/0123"]
    assert (r.sku, r.upc, r.warehouse_location, r.inv_run, r.month_end) == ("ABC", "0123", "A12-34", None, False)
    r = out["MISC SUPPLY x"]
    assert (r.misc_supply, r.month_end, r.month_end_date) == (True, False, D(2023, 2, 28))


LINES = ("qty_in string, textbox_12 string, name string, ship_date string, textbox_15 string, transaction_id string, textbox_14 string, "
         "tracking_number string, textbox_67 string, materials string" + LINEAGE)
REGISTER = ("transaction_id string, name string, date string, ship_date string, carrier string, customer_ref_ string, tracking_number string, "
            "ship_to_company string, qty_in string, qty_out string, handling string, materials string, storage string, special string, "
            "freight_pp string, total string, notes string" + LINEAGE)


def line_rows():
    return lined([
        {"qty_in": "T1", "textbox_12": ".B", "ship_date": "01/02/23", "textbox_14": "123", "tracking_number": "PO2", "materials": "4"},
        {"qty_in": "T1", "textbox_12": "A-DELETE", "ship_date": "01/02/2023- CAN", "textbox_14": "1Z", "tracking_number": "PO1", "materials": "x"},
        {"qty_in": "T1", "textbox_12": "C", "ship_date": "never", "tracking_number": None},
        {"qty_in": "T2", "textbox_12": "A", "tracking_number": "PO9"},
        {"qty_in": None, "textbox_12": "A"},
    ])


def test_transaction_lines(spark):
    out = by(feeds.parse_transaction_lines(make(spark, line_rows(), LINES)), "transaction_id", "index")
    assert set(out) == {("T1", 0), ("T1", 1), ("T1", 2), ("T2", 0)}
    first = out[("T1", 0)]  # ".B" sorts before "A-DELETE"
    assert (first.sku, first.ship_date, first.tracking_num, first.quantity) == ("B", D(2023, 1, 2), "123", 4)
    second = out[("T1", 1)]
    assert (second.sku, second.ship_date, second.tracking_num, second.quantity) == ("A", D(2023, 1, 2), None, None)
    assert out[("T1", 2)].ship_date is None


def test_transaction_register(spark):
    lines = feeds.parse_transaction_lines(make(spark, line_rows(), LINES))
    base = {"date": "1/2/23", "ship_date": "01/03/2023", "qty_in": "7", "total": "x"}
    rows = lined([
        {**base, "transaction_id": "T1", "ship_date": "01/03/2023- CAN"},
        {**base, "transaction_id": "T1"},                       # the same id twice: two rows
        {**base, "transaction_id": "T2"},                       # one PO only: not retail
        {**base, "transaction_id": None},
        {**base, "transaction_id": "T4", "date": "12/31/2019"},  # too old
        {**base, "transaction_id": "T5", "date": "soon"},
        {**base, "transaction_id": "T6", "ship_date": "later"},
    ])
    out = feeds.parse_transaction_register(make(spark, rows, REGISTER), lines).collect()
    assert sorted(r.id for r in out) == ["T1", "T1", "T2"]
    t1 = [r for r in out if r.id == "T1"]
    assert {(r.po_number, r.retail) for r in t1} == {("PO1", True)}
    assert sorted(r.cancelled for r in t1) == [False, True]
    t2 = next(r for r in out if r.id == "T2")
    assert (t2.po_number, t2.retail, t2.quantity_in, t2.charge_total) == (None, False, 7, None)
    assert (t2.period_first_day, t2.period_last_day) == (D(2023, 1, 1), D(2023, 1, 31))


def test_3pl_inventory(spark):
    ddl = ("product_code string, product_description string, product_description_2 string, upc_code string, quantity_on_hand string, "
           "quantity_allocated string, available_inv_oh string, unit_case_eaches_carton string" + LINEAGE)
    rows = lined([{"product_code": "A", "upc_code": "000000000000", "quantity_on_hand": "5"}], "pre_2023-02-01_x.csv")
    r = feeds.parse_3pl_inventory(make(spark, rows, ddl), "pre_").first()
    assert (r.report_date, r.upc, r.quantity_on_hand, r.quantity_allocated) == (D(2023, 2, 1), None, 5, None)


# ---- inventory history ---------------------------------------------------------


def test_inventory_history(spark):
    snaps = "sku string, sku_name string, on_hand bigint, on_hold bigint, available bigint, inv_date date"
    reno = make(spark, [
        {"sku": "A", "sku_name": "old", "on_hand": 1, "on_hold": None, "available": 1, "inv_date": D(2023, 1, 2)},
        {"sku": "alias", "sku_name": "new", "on_hand": 2, "on_hold": 3, "available": None, "inv_date": D(2023, 1, 2)},
        {"sku": "A", "sku_name": "old", "on_hand": 9, "on_hold": None, "available": 9, "inv_date": D(2023, 1, 4)},
        {"sku": "Z", "sku_name": "zz", "on_hand": 7, "inv_date": D(2022, 1, 1)},   # before the range
        {"sku": "N", "sku_name": "nn", "on_hand": None, "inv_date": D(2023, 1, 2)},  # no stock figure
    ], snaps)
    master = make(spark, [{"sku": "A", "sku_name": "Item A", "upc": "1", "sku_type": "Finished Good", "status": None}],
                  "sku string, sku_name string, upc string, sku_type string, status string")
    mapping = make(spark, [{"warehouse_sku": "alias", "sku_ref": "A"}], "warehouse_sku string, sku_ref string")
    feed = inventory.Feed(reno, "Reno", patterns=inventory.SKU_TYPE_PATTERNS, name_from_feed=False, need_stock=True)
    lo, hi = F.lit(D(2023, 1, 1)), F.lit(D(2023, 1, 5))
    out = by(inventory.inventory_history([feed], mapping, master, lo, hi), "sku", "date")
    stock = lambda s: [out[(s, D(2023, 1, d))].total_on_hand for d in range(1, 6)]
    assert stock("A") == [None, 3, 3, 9, 9]
    assert stock("Z") == [None] * 5
    assert not any(k[0] == "N" for k in out)
    r = out[("A", D(2023, 1, 4))]
    assert (r.total_on_hold, r.total_available, r.sku_name, r.product_type, r.status) == (3, 9, "Item A", "Finished Good", "Active")
    assert out[("A", D(2023, 1, 3))].month_end is None and r.month_end is False
    # a reload adds nothing, a rebuild replaces
    full = inventory.inventory_history([feed], mapping, master, lo, hi)
    assert inventory.load_inventory_history(full, full).count() == full.count()
    assert inventory.load_inventory_history(full, full.limit(0), rebuild=True).count() == full.count()


def test_warehouse_map_takes_second_alias(spark):
    raw = make(spark, [{"sku": "a1", "sku_ref": "A", "match": False}, {"sku": "a2", "sku_ref": "A", "match": False},
                       {"sku": "b", "sku_ref": "B", "match": True}, {"sku": "c", "sku_ref": None, "match": False}],
               "sku string, sku_ref string, match boolean")
    stored = make(spark, [{"warehouse_sku": "a1", "sku_ref": "A"}], "warehouse_sku string, sku_ref string")
    assert set(by(inventory.warehouse_map(raw, stored), "warehouse_sku")) == {"a1", "a2"}


# ---- shop and funnel --------------------------------------------------------------

ORDERS = ("order_id bigint, customer_id bigint, created_timestamp timestamp, total_line_items_price double, total_discounts double, "
          "total_price double, refund_subtotal double, new_vs_repeat string, is_confirmed boolean, is_test_order boolean, "
          "is_deleted boolean, source_name string")


def order(i, customer, day, price=10.0, **over):
    return {"order_id": i, "customer_id": customer, "created_timestamp": TS(*day, 12), "total_line_items_price": price,
            "total_discounts": 0.0, "total_price": price, "refund_subtotal": 0.0, "new_vs_repeat": "new", "is_confirmed": True,
            "is_test_order": False, "is_deleted": False, "source_name": "web", **over}


def test_valid_orders(spark):
    rows = [order(1, 1, (2023, 1, 1)), order(2, 1, (2023, 1, 1), is_confirmed=False), order(3, 1, (2023, 1, 1), is_test_order=True),
            order(4, 1, (2023, 1, 1), is_deleted=True), order(5, 1, (2023, 1, 1), source_name="mp"), order(6, 1, (2023, 1, 1), source_name=None)]
    assert [r.order_id for r in funnel.valid_orders(make(spark, rows, ORDERS), "mp").collect()] == [1]


def test_retention(spark):
    rows = [order(1, 1, (2023, 1, 5)), order(2, 2, (2023, 1, 6)), order(3, 1, (2023, 2, 1), 20.0), order(4, None, (2023, 2, 2)),
            order(5, 3, (2023, 4, 1)), order(6, 1, (2023, 4, 2))]
    out = by(funnel.retention(date_spine(spark), make(spark, rows, ORDERS), "mp"), "month_year")
    jan, feb, apr = out["M1 2023"], out["M2 2023"], out["M4 2023"]
    assert (jan.new_customers, jan.unique_customers, jan.repeat_customers, jan.order_count, jan.clv) == (2, 2, 0, 2, 10.0)
    # an order without a customer wins a "customer" but is never a unique or repeat one
    assert (feb.new_customers, feb.unique_customers, feb.repeat_customers, feb.order_count) == (1, 1, 1, 2)
    assert feb.repeat_customer_percentage == 100.0
    # summed month by month: customer 1 counts three times
    assert apr.cumulative_unique_customers == 5 and apr.repeat_customers == 1
    # ages 1, 2, 3: (2*3 + 1*2 + 1*1) / 4
    assert apr.avg_lifespan == 9 / 4 and apr.average_lifetime_orders == 6 / 5


def test_intent_guards(spark):
    spine = date_spine(spark, "2023-01-01", "2023-01-03").select("date")
    orders = make(spark, [order(1, 1, (2023, 1, 1), 0.0), order(2, 1, (2023, 1, 2), 50.0, total_discounts=5.0, refund_subtotal=10.0)], ORDERS)
    daily = make(spark, [{"date_day": D(2023, 1, 2), "count_abandoned_checkouts": 3, "count_customers_abandoned_checkout": 2}],
                 "date_day date, count_abandoned_checkouts bigint, count_customers_abandoned_checkout bigint")
    events = make(spark, [{"date": D(2023, 1, 2), "event_name": "session_start", "total_users": 0}], "date date, event_name string, total_users bigint")
    out = by(funnel.intent(spine, orders, daily, events, "mp"), "date")
    zero, day, quiet = out[D(2023, 1, 1)], out[D(2023, 1, 2)], out[D(2023, 1, 3)]
    assert zero.discount_ratio is None and zero.total_checkouts is None
    assert (day.discount_ratio, day.refund_ratio, day.abandoned_checkout_ratio) == (10.0, 20.0, 75.0)
    assert day.conversion_rate_sessions is None  # no sessions that day
    assert quiet.orders is None


def test_subscribers(spark):
    made = TS(2023, 1, 1, 10)
    later, before = made + dt.timedelta(days=1), made - dt.timedelta(days=1)
    cases = [("subscribed", made), ("subscribed", later), ("subscribed", before), ("subscribed", None), ("unsubscribed", later),
             ("unsubscribed", made), ("unsubscribed", None), ("not_subscribed", later), ("not_subscribed", None), ("pending", later)]
    rows = [{"created_timestamp": made, "marketing_consent_state": s, "marketing_consent_updated_at": u} for s, u in cases]
    customers = make(spark, rows, "created_timestamp timestamp, marketing_consent_state string, marketing_consent_updated_at timestamp")
    r = funnel.subscriber_changes(customers).first()
    assert (r.new_subscribers, r.unsubscribers) == (4, 4)
    out = by(funnel.subscriber_list(date_spine(spark, "2022-12-31", "2023-01-02"), customers), "date")
    assert [out[d].email_list for d in (D(2022, 12, 31), D(2023, 1, 1), D(2023, 1, 2))] == [None, 0, 0]


def test_rolling_metrics_skip_missing_days(spark):
    cols = {n: 0 for n in shop.DAILY_SHOP}
    rows = [{**cols, "date_day": D(2023, 1, d), "shop_id": 1, "currency": "USD", "is_deleted": d == 9, "count_orders": n,
             "order_adjusted_total": v} for d, n, v in [(1, 0, 0.0), (5, 2, 10.0), (7, 1, 5.0), (9, 5, 99.0)]]
    ddl = ", ".join(f"{c} {'date' if c == 'date_day' else 'string' if c == 'currency' else 'double'}" for c in shop.DAILY_SHOP) + ", is_deleted boolean"
    rows = [{k: float(v) if isinstance(v, int) and not isinstance(v, bool) else v for k, v in r.items()} for r in rows]
    key = shop.daily_shop_key(make(spark, rows, ddl))
    out = by(shop.rolling_shop_metrics(date_spine(spark), key, rows=2), "date")
    assert {d.day: r.average_order_value_2_day for d, r in out.items()} == {1: None, 5: 5.0, 7: 5.0}


def test_ads(spark):
    stats = make(spark, [
        {"customer_id": 1, "date": D(2023, 1, 1), "ad_group_id": None, "ad_group_base_ad_group": "customers/1/adGroups/7", "ad_id": 1, "clicks": 1,
         "cost_micros": 1500000, "impressions": 0, "conversions": 0.0, "conversions_value": 0.0},
        {"customer_id": 1, "date": D(2023, 1, 1), "ad_group_id": 7, "ad_group_base_ad_group": "x", "ad_id": 1, "clicks": 1,
         "cost_micros": 500000, "impressions": 0, "conversions": 0.0, "conversions_value": 3.0},
    ], "customer_id bigint, date date, ad_group_id bigint, ad_group_base_ad_group string, ad_id bigint, clicks bigint, cost_micros bigint, impressions bigint, conversions double, conversions_value double")
    hist = lambda rows, ddl: make(spark, rows, ddl + ", is_most_recent_record boolean")
    ad = hist([{"ad_id": 1, "ad_group_id": 7, "ad_name": "new", "is_most_recent_record": True}, {"ad_id": 1, "ad_group_id": 7, "ad_name": "old", "is_most_recent_record": False}],
              "ad_id bigint, ad_group_id bigint, ad_name string, ad_status string, ad_type string, display_url string, source_final_urls string")
    group = hist([{"ad_group_id": 7, "ad_group_name": "G", "campaign_id": 3, "is_most_recent_record": True}], "ad_group_id bigint, ad_group_name string, campaign_id bigint")
    camp = hist([], "campaign_id bigint, campaign_name string, account_id bigint")
    acc = hist([], "account_id bigint, account_name string, currency_code string")
    m = ads.ads_modified(stats, acc, camp, group, ad)
    r = m.first()
    assert m.count() == 1 and (r.ad_name, r.ad_group_name, r.spend, r.clicks, r.campaign_id) == ("new", "G", 2.0, 2, None)
    s = ads.ads_summary(m).first()
    assert (s.ctr, s.cpc, s.roas, s.cpcv) == (None, 1.0, 1.5, None)


# ---- BOM, SKU, purchasing ------------------------------------------------------------

MASTER = ("sku string, sku_name string, upc string, brand string, status string, product_code string, product_group string, sku_type string, "
          "version string, vendor string, vendor_id string, unit string, vendor_sku string")


def test_bom(spark):
    master = make(spark, [
        {"sku": "F1", "sku_name": "Cream", "sku_type": "Finished Good", "status": "Active"},
        {"sku": "F2", "sku_name": "Oil", "sku_type": "Finished Good", "status": "Inactive"},
        {"sku": "C1", "sku_name": "Jar", "product_group": "JAR", "sku_type": "Component"},
        {"sku": "C2", "sku_name": "Odd", "product_group": "???", "sku_type": "Component"},
    ], MASTER)
    raw = make(spark, [
        {"fg_sku": "F1", "component_sku": "C2", "usage": None, "_line": 1}, {"fg_sku": "F1", "component_sku": "C1", "usage": 2.0, "_line": 2},
        {"fg_sku": "F1", "component_sku": "C1", "usage": 3.0, "_line": 0}, {"fg_sku": "F2", "component_sku": "F1", "usage": 1.0, "_line": 4},
        {"fg_sku": "nope", "component_sku": "zzz", "usage": 1.0, "_line": 5},
    ], "fg_sku string, component_sku string, usage double, _line bigint, _fivetran_synced timestamp")
    boms = bom.bom_enrich(raw, master)
    out = by(boms, "fg_sku", "component_index")
    assert [(out[("F1", i)].component_sku, out[("F1", i)]["index"]) for i in (1, 2, 3)] == [("C1", 1), ("C1", 3), ("C2", 2)]
    assert out[("F2", 1)].is_fg is True and out[("nope", 1)].is_fg is False and out[("nope", 1)].fg_sku_name is None
    usage = by(bom.bom_usage_summary(boms), "sku")
    assert (usage["F1"].num_components, usage["F1"].num_missing_usage) == (3, 1)
    assert set(by(bom.bom_usage_summary(boms, only_missing=True), "sku")) == {"F1"}
    groups = make(spark, [{"group_id": "JAR", "group_name": "Jar"}], "group_id string, group_name string, product_type string")
    matrix = by(bom.component_matrix(boms, groups), "sku")
    assert set(matrix) == {"F1"} and matrix["F1"].jar is True and matrix["F1"].cap is None and len(matrix["F1"]) == 31
    prices = make(spark, [{"sku": "C1", "average_price": 2.5}], "sku string, average_price double")
    cost = by(bom.bom_cost(boms, prices, master), "sku")
    assert set(cost) == {"F1"} and cost["F1"].total_cost == 2.5
    assert by(bom.bom_cost(boms, prices, master, weight_by_usage=True), "sku")["F1"].total_cost == 12.5


PO = ("master_po_num string, brand string, status string, fg_po_association string, po_date date, vendor_sku string, sku string, max_lead_time double, "
      "ship_date_lead_time int, ship_date_req string, ship_date_actual string, req_receipt_date string, delivery_date_actual string, invoice_due_date string, "
      "ship_from string, ship_to string, total_po_quantity_sku double, quantity double, quantity_received double, moq double, price_per_unit double, total double, "
      "payment_terms string, pmt_upfront_percent double, pmt_upfront_net bigint, pmt_upfront_addl_percent double, pmt_upfront_addl_net bigint, pmt_ship_percent double, "
      "pmt_ship_net bigint, pmt_delivery_percent double, pmt_delivery_net bigint, pmt_cc boolean, pmt_cc_percent double, pmt_check boolean, new_launch boolean, "
      "launch_date string, _line bigint, _fivetran_synced timestamp")


def po_rows():
    base = {"status": "COMPLETE", "sku": "C1", "ship_from": " Acme Labs ", "ship_to": "N/A", "ship_date_lead_time": 45000, "_fivetran_synced": T0}
    return [
        {**base, "master_po_num": "P1", "_line": 1, "po_date": D(2023, 1, 1), "quantity": 10.0, "quantity_received": 8.0, "price_per_unit": 1.005, "total": 10.0},
        {**base, "master_po_num": "P2", "_line": 2, "po_date": D(2023, 1, 1), "quantity": 10.0, "quantity_received": None, "price_per_unit": 3.0, "total": 30.0},
        {**base, "master_po_num": "P3", "_line": 3, "po_date": D(2023, 2, 1), "quantity": 5.0, "quantity_received": 0.0, "price_per_unit": 2.0, "total": 10.0,
         "delivery_date_actual": "2023-02-20 x", "ship_date_actual": "TBD"},
        {**base, "master_po_num": "P4", "_line": 4, "status": "SHIPPING", "quantity": 5.0, "quantity_received": 5.0, "price_per_unit": 2.0, "total": 10.0},
        {**base, "master_po_num": "P0", "_line": 5, "_fivetran_synced": T0 - dt.timedelta(days=1), "quantity": 1.0, "quantity_received": 1.0, "price_per_unit": 9.0, "total": 9.0},
    ]


VENDORS = [{"id": 1, "display_name": "Acme Labs"}, {"id": 2, "display_name": "ACME LABS"}, {"id": 3, "display_name": "Acme Lab (deleted)"}]


def purchasing_inputs(spark):
    vendors = make(spark, VENDORS, "id bigint, display_name string, print_on_check_name string")
    master = make(spark, [{"sku": "C1", "sku_name": "Jar", "upc": "1", "brand": "b", "sku_type": "Component", "status": "Active"}], MASTER)
    status = make(spark, [{"po_statuses": "SHIPPING", "type": "OPEN"}, {"po_statuses": "COMPLETE", "type": None}], "po_statuses string, type string")
    brands = make(spark, [{"brand_id": "b", "brand_name": "Brand"}], "brand_id string, brand_name string")
    return make(spark, po_rows(), PO), master, vendors, status, brands


def test_tracker(spark):
    raw, master, vendors, status, brands = purchasing_inputs(spark)
    mapping = purchasing.vendor_mapping(raw, vendors)
    assert sorted((r.po_name, r.id, r.row_num) for r in mapping.collect()) == [("Acme Labs", 1, 2), ("Acme Labs", 2, 1)] or sorted(
        (r.po_name, r.id, r.row_num) for r in mapping.collect()) == [("Acme Labs", 1, 1), ("Acme Labs", 2, 2)]
    # padded names do not match the trimmed map, as in the original join
    tracker = purchasing.po_tracker(raw, master, mapping, purchasing.po_status(status))
    out = by(tracker, "master_po_num")
    assert out["P1"].ship_from_id is None and out["P1"].ship_date_lead_time == D(2023, 3, 15)
    assert (out["P1"].per_unit_order, out["P1"].per_unit_effective) == (1.01, 1.25)
    assert out["P2"].per_unit_effective is None and out["P3"].per_unit_effective is None and out["P4"].per_unit_effective is None
    assert (out["P3"].delivery_date_actual, out["P3"].ship_date_actual) == (D(2023, 2, 20), None)
    assert {k: r.latest for k, r in out.items()} == {"P1": True, "P2": True, "P3": True, "P4": True, "P0": False}
    assert {r.master_po_num for r in purchasing.tracker_clean(tracker, "open").collect()} == {"P4"}
    assert purchasing.tracker_clean(tracker, "complete").count() == 3


def test_prices(spark):
    raw, master, vendors, status, brands = purchasing_inputs(spark)
    no_map = make(spark, [], "po_name string, id bigint, row_num int")
    tracker = purchasing.po_tracker(raw, master, no_map, purchasing.po_status(status))
    price = purchasing.average_price(tracker, master, brands).first()
    assert (price.average_price_order, price.average_price_effective, price.order_effective_delta, price.brand) == (2.0, 6.25, 4.25, "Brand")
    bought = purchasing.purchases(tracker)
    cost = by(purchasing.running_inventory_cost(bought), "master_po_num")
    # P1 and P2 share a day, so both see the whole day
    assert cost["P1"].average_inventory_cost_at_po_date == cost["P2"].average_inventory_cost_at_po_date == 2.0
    assert cost["P3"].average_inventory_cost_at_po_date == 2.0 and cost["P3"].average_effective_price is None
    assert cost["P1"].adjusted_average_cost_based_on_received == 2.22
    line = by(purchasing.price_timeline(bought), "effective_from")
    assert line[D(2023, 1, 1)].effective_to == D(2023, 2, 20) and line[D(2023, 2, 20)].effective_to is None
    assert line[D(2023, 2, 20)].total_cost == 50.0
    held = make(spark, [{"date": D(2023, 1, 1), "sku": "C1"}, {"date": D(2023, 1, 2), "sku": "C1"}, {"date": D(2023, 1, 1), "sku": "other"}], "date date, sku string")
    cum = by(purchasing.cumulative_purchases(held, purchasing.running_inventory_cost(bought)), "sku", "date")
    assert cum[("C1", D(2023, 1, 2))].cumulative_total_purchase_cost_by_sku == 40.0
    assert cum[("other", D(2023, 1, 1))].cumulative_total_purchase_cost_by_sku is None
    assert cum[("C1", D(2023, 1, 1))].weighted_avg_order_price_based_on_received == pytest.approx((40 - ((10 - 8 * 2.22) + (30 - 10 * 2.22))) / 20)


# ---- sales, finance, EDI, audience ---------------------------------------------------


def test_retail_sales(spark):
    items = make(spark, [{"id": 1, "name": "n1", "stock_keeping_unit": "S1"}, {"id": 2, "name": "S2", "stock_keeping_unit": None}, {"id": 3, "name": "x", "stock_keeping_unit": "U1"}],
                 "id bigint, name string, stock_keeping_unit string")
    master = make(spark, [{"sku": "S1", "sku_name": "One", "upc": "U1"}, {"sku": "S2", "sku_name": "Two", "upc": "U2"}], MASTER)
    mapping = sales.item_ref_mapping(items, master)
    assert {k: r.ref_sku for k, r in by(mapping, "qb_id").items()} == {1: "S1", 2: "S2", 3: "S1"}
    inv = make(spark, [{"id": 9, "transaction_date": D(2023, 1, 1)}], "id bigint, transaction_date date")
    lines = make(spark, [{"invoice_id": 9, "sales_item_item_id": 2, "amount": 5.0}, {"invoice_id": 9, "amount": 1.0}, {"invoice_id": 9, "sales_item_item_id": 77, "amount": 2.0}],
                 "invoice_id bigint, sales_item_item_id bigint, amount double")
    out = sales.retail_sales(inv, lines, items, mapping).collect()
    assert sorted((str(r.ref_sku), str(r.sku_name), r.amount) for r in out) == [("None", "None", 2.0), ("S2", "Two", 5.0)]
    assert sales.unmapped_lines(lines).count() == 1


def test_edi(spark):
    ddl = "textbox_23 string, textbox_17 string, textbox_19 string, textbox_21 string, textbox_15 string, alt_doc_num string, txn_amount string" + LINEAGE
    raw = make(spark, lined([
        {"textbox_23": "Acme", "textbox_17": "01/31/2023", "textbox_19": "1", "textbox_21": "810-Invoice", "txn_amount": "$1,234.50"},
        {"textbox_23": "Acme", "textbox_17": None, "textbox_19": "2"}, {"textbox_23": "Other", "textbox_17": "1/2/2023", "textbox_19": "3", "txn_amount": "(5)"},
    ]), ddl)
    mapping = make(spark, [{"tc_name": "Acme", "qb_id": "7"}], "tc_name string, qb_id string")
    out = by(edi.parse_register(raw, mapping), "doc_number")
    assert set(out) == {"1", "3"}
    r = out["1"]
    assert (r.transaction_type_id, r.transaction_type, r.amount, r.creation_date, r.trading_partner_qb_id, r["index"]) == ("810", "Invoice", 1234.5, D(2023, 1, 31), "7", 1)
    assert out["3"].amount is None and out["3"].trading_partner_qb_id is None


def test_finance(spark):
    doc = make(spark, [{"id": 1, "doc_number": "D1", "customer_id": 5, "custom_purchase_order_number": "00123"}, {"id": 2, "doc_number": None, "customer_id": 6}],
               "id bigint, doc_number string, transaction_status string, currency_id string, total_amount double, ship_date date, transaction_date date, customer_id bigint, "
               "custom_purchase_order_number string, custom_store_number string, custom_warehouse string, private_note string, billing_address_id bigint, shipping_address_id bigint, created_at timestamp, updated_at timestamp")
    people = make(spark, [{"id": 5, "fully_qualified_name": "A:B"}], "id bigint, fully_qualified_name string")
    out = by(finance.invoices_view(doc, people), "qb_id")
    assert (out[1].po_number_trim, out[1].customer, out[2].customer) == ("123", "A:B", None)
    links = make(spark, [{"invoice_id": 1, "estimate_id": 3}], "invoice_id bigint, estimate_id bigint")
    est = make(spark, [{"id": 3, "doc_number": "E3"}], "id bigint, doc_number string")
    ref = by(finance.invoice_estimate_ref(doc, links, est, people), "qb_invoice_id")
    assert set(ref) == {1} and (ref[1].estimate_id, ref[1].customer) == ("E3", "A:B")
    detail = make(spark, [{"budget_id": 1, "account_id": 2, "budget_date": D(2024, 2, 1), "amount": 4.0}], "budget_id int, account_id int, budget_date date, amount double")
    budgets = make(spark, [{"id": 1, "name": "B"}], "id int, name string")
    accounts = make(spark, [{"id": 2, "name": "Acc", "classification": "Asset", "account_type": "Bank"}], "id int, name string, classification string, account_type string")
    b = finance.budget(detail, budgets, accounts).first()
    assert "budget_date" not in b and (b.period_first_day, b.period_last_day, b.budget_name) == (D(2024, 2, 1), D(2024, 2, 29), "B")


def test_audience(spark):
    people = make(spark, [{"id": 1, "email": "a@x"}, {"id": 2, "email": None}], "id bigint, email string, first_name string, last_name string")
    homes = make(spark, [
        {"customer_id": 1, "phone": "(212) 555-0142", "country_code": "US", "is_default": True}, {"customer_id": 1, "phone": "1", "is_default": False},
        {"customer_id": 2, "phone": "1", "is_default": True},
    ], "customer_id bigint, city string, zip string, country string, country_code string, phone string, is_default boolean")
    members = audience.audience(people, homes)
    assert members.count() == 1
    phones = audience.normalise_phones(members)
    assert phones.all.first().phone == "+12125550142" and phones.changed.count() == 1 and phones.failed.count() == 0
    assert audience.audience_export(members).columns == ["email", "first_name", "last_name", "zip", "country", "phone"]


# ---- whole refreshes -------------------------------------------------------------------


def test_refresh_warehouse(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    stock = lined([{"customer": "C", "sku": "A", "end_date": "03/31/2023 11:59:00 PM"}])
    history = ("customer string, sku string, item_description string, qualifier string, warehouse string, detail_on_hand string, detail_quarantine_on_hold string, "
               "detail_allocated string, detail_available string, detail_primary_uom string, volume_unit string, weight_unit string, detail_cartons string, detail_dim_uom string, "
               "detail_packed string, detail_cu_ft string, detail_weight string" + LINEAGE)
    raw = {
        "wms_transaction_lines": make(spark, line_rows(), LINES),
        "wms_transaction_register": make(spark, lined([{"transaction_id": "T1", "date": "1/2/23", "ship_date": "01/03/2023"}]), REGISTER),
        "wms_inventory": make(spark, stock, INVENTORY),
        "wms_inventory_history": make(spark, lined([{"customer": "C", "sku": "A", "warehouse": "Warehouse: Reno From 2023-03-31 00:00:00.00"}]), history),
    }
    first = refresh.refresh_warehouse(store, raw, "Brand")
    assert {k: v.new for k, v in first.items()} == {"wms_transaction_lines": 4, "wms_transaction_register": 1, "wms_inventory": 1, "wms_inventory_history": 1}
    again = refresh.refresh_warehouse(store, raw, "Brand")
    assert all(v.new == 0 for v in again.values())
    for table in first:
        stored = store.read(table)
        want = schema(table)
        assert {f.name: f.dataType for f in stored.schema} == {f.name: f.dataType for f in want}, table
        assert typed(stored, want).count() == stored.count()


def test_refresh_purchasing_and_reference(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    raw_po, master, vendors, status, brands = purchasing_inputs(spark)
    store.write("sku_master", master)
    store.write("brands", brands)
    raw = {"po_tracker": raw_po, "po_statuses": status, "vendor": vendors}
    out = refresh.refresh_purchasing(store, raw)
    assert out["po_status"].new == 2 and out["vendor_mapping"].new == 2 and out["po_tracker"].new == 5 and out["average_price"] == 1
    again = refresh.refresh_purchasing(store, raw)
    assert again["po_tracker"].new == 0 and again["average_price"] == 1
    # the same sync delivered again stays the latest one
    assert store.read("po_tracker").filter("latest").count() == 4
    assert store.read("average_price").filter("latest").count() == 1
    boms = make(spark, [{"fg_sku": "F", "component_sku": "C1", "usage": 1.0, "_line": 0}],
                "fg_sku string, component_sku string, usage double, _line bigint, _fivetran_synced timestamp")
    assert refresh.refresh_boms(store, {"boms": boms}) == {"boms": 1}
    assert refresh.refresh_boms(store, {"boms": boms}) == {"boms": 1}
    assert store.read("boms").filter("latest").count() == 1 and store.read("boms").count() == 2
    broken = boms.withColumn("usage", F.raise_error(F.lit("no usage")).cast("double"))
    with pytest.raises(Exception, match="no usage"):
        refresh.refresh_boms(store, {"boms": broken})
    assert store.read("boms").filter("latest").count() == 1 and store.read("boms").count() == 2


def test_refresh_reference_and_edi(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    vendors = make(spark, VENDORS, "id bigint, display_name string, print_on_check_name string")
    cols = [*sku.MASTER_COLUMNS, *sku.MASTER_TAIL, "eaches_per_carton", "notes"]
    master = make(spark, [{"sku": "A", "vendor": "Acme Lab", "eaches_per_carton": "n/a"}, {"sku": "B", "vendor": None, "eaches_per_carton": "12"}],
                  ", ".join(f"{c} string" for c in cols) + ", _fivetran_synced timestamp")
    raw = {
        "sku_master": master, "vendor": vendors,
        "retail_master": make(spark, [{"sku_sold_to_retailer": "A", "retailer": "R"}], "sku_sold_to_retailer string, retailer string, retailer_sku string, upc string, srp double, retail_discount double, retail_srp double"),
        "brands": make(spark, [{"brand_id": "b"}], "brand_id string, brand_name string"),
        "groups": make(spark, [{"group_id": "g"}], "group_id string, group_name string, product_type string"),
    }
    assert all(changed for changed, _ in refresh.refresh_sku_reference(store, raw).values())
    assert not any(changed for changed, _ in refresh.refresh_sku_reference(store, raw).values())
    stored = by(store.read("sku_master"), "sku")
    assert (stored["A"].vendor_id, stored["A"].eaches_per_carton) in {(1, None), (2, None)}
    assert (stored["B"].vendor_id, stored["B"].eaches_per_carton) == (None, 12)
    reg = "textbox_23 string, textbox_17 string, textbox_19 string, textbox_21 string, textbox_15 string, alt_doc_num string, txn_amount string" + LINEAGE
    log = "edipartner_name string, txn_type string, alt_doc_id string, account_id string, amount string, document_date string, log_time string, description string" + LINEAGE
    edi_raw = {
        "fin_customer": make(spark, [{"id": "1", "display_name": "Acme Stores", "fully_qualified_name": "x"}], "id string, display_name string, fully_qualified_name string"),
        "edi_register": make(spark, lined([{"textbox_23": "Acme Store", "textbox_17": "1/2/2023", "textbox_19": "1"}]), reg),
        "edi_integration": make(spark, lined([{"edipartner_name": "Nobody", "document_date": "01/02/2023 01:02:03 PM"}]), log),
    }
    out = refresh.refresh_edi(store, edi_raw)
    assert (out["edi_partner_mapping"].new, out["edi_register"].new, out["edi_integration"].new) == (1, 1, 1)
    assert store.read("edi_register").first().trading_partner_qb_id == "1"
    assert refresh.refresh_edi(store, edi_raw)["edi_partner_mapping"] == LoadStats(0, 1, 1)
