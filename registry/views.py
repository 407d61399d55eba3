"""The business sources as views of the test tables, in SQL both engines read.

``{name}`` stands for a table or another view.
"""

VIEWS = {
    # ---- shop ------------------------------------------------------------
    # money is added up in whole hundredths (or ten-thousandths) of a currency unit
    "order_money": """
        select l_orderkey, n_lines, n_items, n_returned,
               cast(gross / 100.0 as decimal(18,2)) as gross, cast(discount / 10000.0 as decimal(18,4)) as discount,
               cast(tax / 10000.0 as decimal(18,4)) as tax, cast(refund / 100.0 as decimal(18,2)) as refund
        from (select l_orderkey,
                     count(*) as n_lines,
                     sum(cast(l_quantity as bigint)) as n_items,
                     sum(case when l_returnflag = 'R' then cast(l_quantity as bigint) else 0 end) as n_returned,
                     sum(cast(round(l_extendedprice * 100) as bigint)) as gross,
                     sum(cast(round(l_extendedprice * l_discount * 10000) as bigint)) as discount,
                     sum(cast(round(l_extendedprice * l_tax * 10000) as bigint)) as tax,
                     sum(case when l_returnflag = 'R' then cast(round(l_extendedprice * 100) as bigint) else 0 end) as refund
              from {lineitem} group by l_orderkey) m""",
    "shop_orders": """
        select o.o_orderkey as order_id,
               concat('SO-', cast(o.o_orderkey as string)) as name,
               case when o.o_orderpriority = '4-NOT SPECIFIED' and o.o_totalprice > 490000 then null
                    else o.o_custkey end as customer_id,
               o.o_orderdate as created_timestamp,
               o.o_orderdate as processed_timestamp,
               case when o.o_orderstatus = 'P' then o.o_orderdate end as cancelled_timestamp,
               m.gross as total_line_items_price,
               m.discount as total_discounts,
               cast(o.o_totalprice as decimal(18,2)) as total_price,
               m.tax as total_tax,
               m.refund as refund_subtotal,
               cast(m.n_lines as decimal(18,2)) as shipping_cost,
               case when o.o_orderpriority in ('1-URGENT', '2-HIGH') then 'new' else 'repeat' end as new_vs_repeat,
               o.o_orderstatus <> 'P' as is_confirmed,
               o.o_totalprice < 2000 as is_test_order,
               o.o_totalprice > 499000 as is_deleted,
               case o.o_orderpriority when '5-LOW' then 'marketplace'
                    when '3-MEDIUM' then case when o.o_totalprice < 20000 then null else 'web' end
                    else 'web' end as source_name,
               case when o.o_orderstatus = 'F' then 'paid' else 'pending' end as financial_status,
               cast(null as string) as referring_site,
               lower(o.o_orderpriority) as order_tags,
               concat('utm ', o.o_orderpriority, ' Sales') as order_url_tags
        from {orders} o left join {order_money} m on m.l_orderkey = o.o_orderkey""",
    "shop_lines": """
        select l_orderkey as order_id,
               concat('SKU-', cast(l_partkey as string)) as sku,
               concat('Item ', cast(l_partkey as string)) as name,
               l_partkey + 1000000 as product_id,
               cast(l_quantity as bigint) as quantity
        from {lineitem}""",
    # one row per customer and day first, so that customers are counted without a distinct
    "customer_days": """
        select cast(o.o_orderdate as date) as date_day, o.o_custkey, count(*) as n_orders,
               sum(m.n_items) as n_items, sum(m.n_returned) as n_returned, sum(m.n_lines) as n_lines, count(m.n_lines) as n_filled,
               max(m.n_lines) as max_lines, sum(m.gross) as gross, sum(m.discount) as discount, sum(m.refund) as refund, sum(m.tax) as tax,
               sum(case when o.o_orderstatus = 'P' then 1 else 0 end) as n_p,
               sum(case when o.o_orderstatus = 'O' then 1 else 0 end) as n_o,
               sum(case when o.o_orderstatus = 'F' then 1 else 0 end) as n_f,
               sum(case when m.discount > 100 then 1 else 0 end) as n_coded,
               sum(case when m.discount > 0 then 1 else 0 end) as n_discounted,
               sum(case when m.refund > 0 then 1 else 0 end) as n_refunded,
               sum(case when o.o_orderpriority = '1-URGENT' then 1 else 0 end) as n_urgent,
               sum(case when o.o_orderpriority = '2-HIGH' then 1 else 0 end) as n_high,
               sum(case when o.o_orderpriority = '3-MEDIUM' then 1 else 0 end) as n_medium,
               sum(case when o.o_orderpriority = '5-LOW' then 1 else 0 end) as n_low
        from {orders} o left join {order_money} m on m.l_orderkey = o.o_orderkey
        group by cast(o.o_orderdate as date), o.o_custkey""",
    "daily_shop": """
        select d.date_day,
               cast(c.c_nationkey as bigint) as shop_id,
               concat('CUR', cast(n.n_regionkey as string)) as currency,
               c.c_nationkey = 24 as is_deleted,
               sum(d.n_orders) as count_orders,
               coalesce(sum(d.n_items), 0) as quantity_sold,
               coalesce(sum(d.n_returned), 0) as quantity_refunded,
               cast(sum(d.n_lines) as double) / nullif(sum(d.n_filled), 0) as avg_line_item_count,
               count(*) as count_customers,
               coalesce(sum(d.gross), 0) as order_adjusted_total,
               coalesce(sum(d.discount), 0) as total_discounts,
               coalesce(sum(d.refund), 0) as refund_subtotal,
               coalesce(sum(d.tax), 0) as refund_total_tax,
               cast(coalesce(sum(d.n_lines), 0) as decimal(18,2)) as shipping_cost,
               cast(sum(d.n_filled) as decimal(18,2)) as shipping_discount_amount,
               cast(sum(d.n_p) as decimal(18,2)) as order_adjustment_amount,
               cast(sum(d.n_o) as decimal(18,2)) as order_adjustment_tax_amount,
               sum(d.n_coded) as count_discount_codes_applied,
               sum(d.n_discounted) as count_orders_with_discounts,
               sum(d.n_refunded) as count_orders_with_refunds,
               coalesce(sum(d.n_lines), 0) as count_variants_sold,
               coalesce(max(d.max_lines), 0) as count_products_sold,
               sum(d.n_urgent) as quantity_gift_cards_sold,
               sum(d.n_high) as quantity_requiring_shipping,
               sum(d.n_p) as count_abandoned_checkouts,
               sum(case when d.n_p > 0 then 1 else 0 end) as count_customers_abandoned_checkout,
               sum(d.n_medium) as count_fulfillment_attempted_delivery,
               sum(d.n_f) as count_fulfillment_delivered,
               sum(d.n_low) as count_fulfillment_failure,
               sum(d.n_o) as count_fulfillment_confirmed
        from {customer_days} d
        join {customer} c on c.c_custkey = d.o_custkey
        join {nation} n on n.n_nationkey = c.c_nationkey
        group by d.date_day, c.c_nationkey, n.n_regionkey""",
    "daily_shop_total": """
        select cast(o_orderdate as date) as date_day,
               sum(case when o_orderstatus = 'P' then 1 else 0 end) as count_abandoned_checkouts,
               count(distinct case when o_orderstatus = 'P' then o_custkey end) as count_customers_abandoned_checkout
        from {orders} group by cast(o_orderdate as date)""",
    # ---- site and ads: events moved back by 9,500 days, onto the order years --
    "site_events": """
        select event_id, user_id, event_type, value, props,
               cast(ts - interval 9500 day as timestamp) as happened_at,
               cast(ts - interval 9500 day as date) as day
        from {events}""",
    "engagement_events": """
        select day as date, event_name, count(*) as event_count, count(distinct user_id) as total_users
        from (select day, user_id, case event_type when 'view' then 'session_start' when 'click' then 'click'
                     when 'purchase' then 'view_item' when 'signup' then 'user_engagement'
                     else 'scroll' end as event_name
              from {site_events}
              union all
              select day, user_id, 'first_visit' as event_name from {site_events} where event_type = 'signup') e
        group by day, event_name""",
    "engagement_content": """
        select day as date,
               count(distinct case when event_type = 'signup' then user_id end) as new_users,
               count(distinct user_id) as total_users,
               sum(case when event_type = 'view' then 1 else 0 end) as screen_page_views,
               cast(sum(cast(value as decimal(18,2))) as double) as user_engagement_duration
        from {site_events} group by day""",
    "ecom_item_brand": """
        select day as date, event_type as item_brand, count(*) as items_added_to_cart,
               cast(count(distinct user_id) as double) / count(*) as cart_to_view_rate
        from {site_events} group by day, event_type""",
    "social_history": """
        select happened_at as _fivetran_synced, event_id as followers_count from {site_events}
        where event_type = 'purchase' and value > 40""",
    "shop_customers": """
        select happened_at as created_timestamp,
               case event_type when 'signup' then 'subscribed' when 'error' then 'unsubscribed'
                    when 'click' then 'not_subscribed' else 'pending' end as marketing_consent_state,
               case when value < 5 then null
                    when value < 10 then cast(happened_at - interval 1 day as timestamp)
                    when value < 15 then happened_at
                    else cast(happened_at + interval 1 day as timestamp) end as marketing_consent_updated_at
        from {site_events}""",
    "search_ads": """
        select day as date_day, count(*) as impressions, sum(case when value > 10 then 1 else 0 end) as clicks,
               cast(sum(cast(value as decimal(18,2))) as double) as spend
        from {site_events} where event_type = 'view' group by day""",
    "social_ads": """
        select day as date_day, count(*) as impressions, sum(case when value > 10 then 1 else 0 end) as clicks,
               cast(sum(cast(value as decimal(18,2))) as double) as spend
        from {site_events} where event_type = 'click' and value > 3 group by day""",
    "photo_insights": """
        select day as date, count(*) as impressions, sum(case when value > 10 then 1 else 0 end) as website_clicks
        from {site_events} where event_type = 'signup' group by day""",
    "market_ads": """
        select day as date, user_id as ad_group, count(*) as impressions,
               sum(case when value > 10 then 1 else 0 end) as clicks,
               sum(cast(value as decimal(18,2))) as cost
        from {site_events} where event_type = 'purchase' group by day, user_id""",
    "ad_stats": """
        select c.c_nationkey as customer_id, e.day as date,
               case when e.event_type = 'error' then null else c.c_nationkey end as ad_group_id,
               concat('customers/1/adGroups/', cast(c.c_nationkey as string)) as ad_group_base_ad_group,
               'SEARCH' as ad_network_type, 'MOBILE' as device,
               e.user_id as ad_id, n.n_regionkey as campaign_id,
               case when e.event_type = 'click' then 1 else 0 end as clicks,
               cast(round(e.value * 1000000) as bigint) as cost_micros,
               case when e.event_type = 'view' then 1 else 0 end as impressions,
               case when e.event_type = 'purchase' then 1 else 0 end as conversions,
               case when e.event_type = 'purchase' then cast(e.value as decimal(18,2)) else 0 end as conversions_value
        from {site_events} e
        join {customer} c on c.c_custkey = e.user_id
        join {nation} n on n.n_nationkey = c.c_nationkey""",
    "ad_history": """
        select c_custkey as ad_id, c_nationkey as ad_group_id, c_name as ad_name, c_mktsegment as ad_status,
               'RESPONSIVE' as ad_type, lower(c_name) as display_url,
               concat('https://shop.example/', c_name) as source_final_urls, c_acctbal > 0 as is_most_recent_record
        from {customer}""",
    "ad_group_history": """
        select n_nationkey as ad_group_id, n_name as ad_group_name, n_regionkey as campaign_id,
               n_nationkey <> 7 as is_most_recent_record
        from {nation}""",
    "campaign_history": """
        select r_regionkey as campaign_id, r_name as campaign_name,
               case when r_regionkey < 3 then 100 else 200 end as account_id, r_regionkey <> 4 as is_most_recent_record
        from {region}""",
    "account_history": """
        select account_id, concat('Account ', cast(account_id as string)) as account_name, 'USD' as currency_code,
               true as is_most_recent_record
        from (select distinct account_id from {campaign_history}) a""",
    # ---- SKU reference ------------------------------------------------------
    "sku_master": """
        select concat('SKU-', cast(p_partkey as string)) as sku,
               p_name as sku_name,
               lpad(cast(p_partkey as string), 12, '0') as upc,
               p_brand as brand,
               case when p_size > 10 then 'Active' else 'Inactive' end as status,
               p_brand as product_code,
               p_type as product_group,
               case when p_type in ('PROMO', 'STANDARD') then 'Finished Good' else 'Component' end as sku_type,
               cast(p_size as string) as version,
               p_name as vendor,
               concat('V', cast(p_size as string)) as vendor_id,
               'EA' as unit,
               concat('VS-', cast(p_partkey as string)) as vendor_sku
        from {part}""",
    "sku_known": "select * from {sku_master} where status = 'Active'",
    "brands": """
        select distinct p_brand as brand_id, concat('The ', p_brand) as brand_name from {part}""",
    "groups": """
        select p_type as group_id, lower(p_type) as group_name, 'Component' as product_type
        from {part} where p_type <> 'ECONOMY' group by p_type""",
    # ---- vendors and partners ---------------------------------------------
    "vendors": """
        select min(p_partkey) as id,
               concat(p_name, case when p_type = 'PROMO' then ' (deleted)' else concat(' ', lower(p_type)) end) as display_name,
               min(p_brand) as print_on_check_name
        from {part} group by p_name, p_type""",
    "fin_customers": """
        select min(p_partkey) as id, concat(p_name, ' ', p_brand) as display_name,
               concat('Group:', p_brand, ' ', p_name) as fully_qualified_name
        from {part} group by p_brand, p_name""",
    # ---- bill of material -------------------------------------------------
    "bom_raw": """
        select concat('SKU-', cast(l_suppkey as string)) as fg_sku,
               concat('SKU-', cast(l_partkey as string)) as component_sku,
               nullif(sum(l_quantity), 1) as usage,
               l_orderkey as _line,
               max(l_shipdate) as _fivetran_synced
        from {lineitem} group by l_suppkey, l_partkey, l_orderkey""",
    # ---- purchase orders -----------------------------------------------------
    "po_raw": """
        select concat('PO-', cast(l.l_orderkey as string)) as master_po_num,
               p.p_brand as brand,
               case when l.l_linestatus = 'F' then 'COMPLETE' else 'SHIPPING' end as status,
               ' fg ' as fg_po_association,
               cast(l.l_shipdate as date) as po_date,
               concat(' ', p.p_brand) as vendor_sku,
               concat('SKU-', cast(l.l_partkey as string)) as sku,
               cast(p.p_size as double) as max_lead_time,
               45000 + p.p_size as ship_date_lead_time,
               cast(cast(l.l_shipdate as date) as string) as ship_date_req,
               case when l.l_returnflag = 'R' then 'pending' else cast(cast(l.l_shipdate as date) as string) end as ship_date_actual,
               cast(null as string) as req_receipt_date,
               case when l.l_quantity > 45 then null else cast(cast(l.l_shipdate + interval 9 day as date) as string) end as delivery_date_actual,
               'n/a' as invoice_due_date,
               p.p_name as ship_from,
               case when p.p_type = 'LARGE' then 'N/A' else concat(p.p_name, ' ', lower(p.p_type)) end as ship_to,
               l.l_quantity as total_po_quantity_sku,
               l.l_quantity as quantity,
               case when l.l_linenumber = 7 then 0 when l.l_linenumber = 6 then null else l.l_quantity - 1 end as quantity_received,
               1.0 as moq,
               cast(l.l_extendedprice * (1 - l.l_discount) as decimal(18,4)) as price_per_unit,
               cast(l.l_extendedprice as decimal(18,2)) as total,
               'NET 30' as payment_terms,
               l.l_discount as pmt_upfront_percent, 30 as pmt_upfront_net,
               cast(null as double) as pmt_upfront_addl_percent, cast(null as bigint) as pmt_upfront_addl_net,
               cast(null as double) as pmt_ship_percent, cast(null as bigint) as pmt_ship_net,
               cast(null as double) as pmt_delivery_percent, cast(null as bigint) as pmt_delivery_net,
               false as pmt_cc, cast(null as double) as pmt_cc_percent, true as pmt_check,
               p.p_size = 1 as new_launch,
               cast(null as string) as launch_date,
               l.l_orderkey * 8 + l.l_linenumber as _line,
               case when l.l_returnflag = 'A' then timestamp '2002-01-01 03:00:10'
                    when l.l_returnflag = 'N' then timestamp '2002-01-01 03:00:50'
                    else timestamp '2001-12-31 03:00:00' end as _fivetran_synced
        from {lineitem} l join {part} p on p.p_partkey = l.l_partkey""",
    "po_status_raw": """
        select distinct case when l_linestatus = 'F' then 'COMPLETE' else 'SHIPPING' end as po_statuses,
               case when l_linestatus = 'F' then null else 'OPEN' end as type
        from {lineitem}""",
    # ---- raw drops: one file per month, one line per order ---------------
    "drops": """
        select concat(substr(cast(cast(o_orderdate as date) as string), 1, 7), '.csv') as _file,
               o_orderkey as _line,
               cast(o_orderdate as date) as report_date,
               o_orderdate as _modified,
               o_custkey as customer_id,
               o_orderpriority as priority,
               cast(o_totalprice as decimal(18,2)) as amount
        from {orders}""",
    "stored_drops": "select * from {drops} where report_date < date '2000-01-01'",
    "arriving_drops": "select * from {drops} where report_date >= date '1999-06-01'",
    # ---- warehouse reports ------------------------------------------------
    "dirty_items": """
        select p_partkey, p_size,
               case p_size % 6
                    when 0 then concat('.', p_brand, '-', cast(p_partkey as string), '-DELETE')
                    when 1 then concat(p_brand, cast(p_partkey as string), ' SKU#:A12-34/', lpad(cast(p_partkey as string), 12, '0'))
                    when 2 then concat('MISC SUPPLY ', p_name)
                    when 3 then concat(p_name, ' ', cast(p_partkey as string), '-DELETE')
                    when 4 then concat(p_brand, 'SKU#:', lpad(cast(p_partkey as string), 12, '0'))
                    else concat(p_type, ' . ', cast(p_partkey as string)) end as sku,
               case p_size % 4
                    when 0 then concat('B07-11 ', p_name)
                    when 1 then concat(p_name, ' DELETED')
                    when 2 then concat('C08-12', p_name)
                    else p_name end as item_description,
               case when p_size % 5 = 0 then concat('Q', cast(p_size as string)) end as qualifier
        from {part}""",
    "wms_report": """
        select case when d.p_size = 49 then null else 'Customer A' end as customer,
               d.sku, d.item_description, d.qualifier,
               case d.p_size % 3 when 0 then 'Warehouse: Reno From 2023-03-31 00:00:00.00'
                    else 'Warehouse: North From 2023-03-15 00:00:00.00' end as warehouse,
               case d.p_size % 3 when 0 then concat('1,', lpad(cast(d.p_size as string), 3, '0')) when 1 then 'abc'
                    else concat(cast(d.p_size as string), '.5') end as detail_on_hand,
               '3' as textbox_39, '4' as detail_quarantine_on_hold, '1,000.25' as detail_available,
               'EA' as textbox_15, 'EA' as detail_primary_uom, 'IN' as textbox_18, 'IN' as volume_unit,
               'LB' as textbox_42, 'LB' as weight_unit, '2,000' as detail_cartons, 'CS' as textbox_28, 'CS' as detail_dim_uom,
               '7' as detail_packed, '1.5' as detail_cu_ft, cast(null as string) as detail_weight,
               case d.p_size % 4 when 0 then '03/31/2023 11:59:00 PM' when 1 then '2/28/2023 1:05:09 AM'
                    when 2 then 'yesterday' else '03/15/2023 12:00:00 PM' end as end_date,
               'stock.csv' as _file, d.p_partkey as _line,
               case when d.p_size > 25 then timestamp '2023-04-02 00:00:00' else timestamp '2023-04-01 00:00:00' end as _modified,
               timestamp '2023-04-02 01:00:00' as _fivetran_synced
        from {dirty_items} d""",
    "wms_snapshots": """
        select concat('SKU-', cast(l_partkey as string)) as sku,
               concat('Item ', l_returnflag) as sku_name,
               cast(l_quantity as bigint) as on_hand,
               cast(l_linenumber as bigint) as on_hold,
               cast(l_quantity as bigint) - l_linenumber as available,
               cast(l_shipdate as date) as inv_date
        from {lineitem} where l_linestatus = 'F'""",
    "tpl_snapshots": """
        select concat('SKU-', cast(l_partkey as string)) as sku,
               concat('Item ', l_returnflag) as sku_name,
               cast(l_quantity as bigint) as on_hand,
               cast(l_linenumber as bigint) as on_hold,
               case when l_linenumber = 3 then null else cast(l_quantity as bigint) - l_linenumber end as available,
               cast(l_shipdate as date) as inv_date
        from {lineitem} where l_linestatus = 'O'""",
    "warehouse_mapping": """
        select concat('SKU-', cast(p_partkey as string)) as sku,
               case when p_size = 50 then null else concat('SKU-', cast(p_size as string)) end as sku_ref,
               p_type = 'LARGE' as match
        from {part} where p_size > 40""",
    "register_raw": """
        select case when o_orderpriority = '4-NOT SPECIFIED' and o_totalprice > 480000 then null
                    else concat('T', cast(o_orderkey as string)) end as transaction_id,
               concat('Brand ', o_orderstatus) as name,
               case o_orderpriority
                    when '1-URGENT' then concat(cast(month(o_orderdate) as string), '/', cast(day(o_orderdate) as string), '/', cast(year(o_orderdate) as string))
                    when '2-HIGH' then concat(lpad(cast(month(o_orderdate) as string), 2, '0'), '/', lpad(cast(day(o_orderdate) as string), 2, '0'), '/', cast(year(o_orderdate) as string))
                    when '3-MEDIUM' then concat(lpad(cast(month(o_orderdate) as string), 2, '0'), '/', lpad(cast(day(o_orderdate) as string), 2, '0'), '/21')
                    when '5-LOW' then 'soon'
                    else concat(lpad(cast(month(o_orderdate) as string), 2, '0'), '/', lpad(cast(day(o_orderdate) as string), 2, '0'), '/2020') end as date,
               concat(lpad(cast(month(o_orderdate) as string), 2, '0'), '/', lpad(cast(day(o_orderdate) as string), 2, '0'), '/2022',
                      case o_orderstatus when 'P' then '- CAN' else '' end) as ship_date,
               concat('Carrier ', o_orderstatus) as carrier,
               cast(o_custkey as string) as customer_ref_,
               cast(o_orderkey as string) as tracking_number,
               concat('Customer ', cast(o_custkey as string)) as ship_to_company,
               case when o_orderstatus = 'F' then 'none' else cast(o_custkey as string) end as qty_in,
               '12' as qty_out,
               cast(cast(o_totalprice as decimal(18,2)) as string) as handling,
               'free' as materials, '0.50' as storage, cast(null as string) as special, '7' as freight_pp,
               cast(cast(o_totalprice as decimal(18,2)) as string) as total,
               'note' as notes,
               concat(substr(cast(cast(o_orderdate as date) as string), 1, 7), '.csv') as _file,
               o_orderkey as _line, o_orderdate as _modified, o_orderdate as _fivetran_synced
        from {orders}""",
    "register_lines": """
        select concat('T', cast(l_orderkey as string)) as transaction_id,
               row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) - 1 as index,
               case when l_linenumber > 4 then null else concat('PO', cast(l_partkey as string), l_returnflag) end as po_number,
               cast(l_partkey as string) as _row_id
        from {lineitem}""",
    "line_report": """
        select concat('T', cast(l_suppkey as string)) as qty_in,
               concat(case when l_returnflag = 'R' then '.' else '' end, 'SKU ', cast(l_partkey as string),
                      case when l_linestatus = 'O' then '-DELETE' else '' end) as textbox_12,
               concat('Brand ', l_returnflag) as name,
               concat(lpad(cast(month(l_shipdate) as string), 2, '0'), '/', lpad(cast(day(l_shipdate) as string), 2, '0'), '/',
                      case when l_linenumber < 4 then '22' else '2022' end, case when l_linestatus = 'F' then '- CAN' else '' end) as ship_date,
               l_linestatus as textbox_15,
               cast(l_orderkey as string) as transaction_id,
               case when l_linenumber = 1 then 'none' else concat('00', cast(l_orderkey as string)) end as textbox_14,
               concat('PO', cast(l_orderkey as string)) as tracking_number,
               'Reno' as textbox_67,
               cast(n_items as string) as materials,
               concat(l_linestatus, l_returnflag, '.csv') as _file,
               l_orderkey * 8 + l_linenumber as _line,
               l_shipdate as _modified, l_shipdate as _fivetran_synced
        from (select l_suppkey, l_partkey, l_orderkey, l_linenumber, l_linestatus, l_returnflag,
                     max(l_shipdate) as l_shipdate, sum(cast(l_quantity as bigint)) as n_items
              from {lineitem} group by l_suppkey, l_partkey, l_orderkey, l_linenumber, l_linestatus, l_returnflag) l""",
    "tpl_report": """
        select concat('SKU-', cast(p_partkey as string)) as product_code, p_name as product_description,
               p_type as product_description_2,
               case when p_size < 5 then '000000000000' else lpad(cast(p_partkey as string), 12, '0') end as upc_code,
               cast(p_size as string) as quantity_on_hand, '1' as quantity_allocated,
               cast(p_size - 1 as string) as available_inv_oh, 'x' as unit_case_eaches_carton,
               concat('stock_report_2023-0', case when p_type = 'LARGE' then '2' else '1' end, '-28_', p_brand, '.csv') as _file,
               p_partkey as _line, timestamp '2023-03-01 00:00:00' as _modified, timestamp '2023-03-01 00:00:00' as _fivetran_synced
        from {part}""",
    # ---- finance, EDI, audience ----------------------------------------------
    "invoices": """
        select o_orderkey as id,
               case when o_orderstatus = 'P' then null else concat('INV', cast(o_orderkey as string)) end as doc_number,
               'open' as transaction_status, 'USD' as currency_id, cast(o_totalprice as decimal(18,2)) as total_amount,
               cast(o_orderdate as date) as ship_date, cast(o_orderdate as date) as transaction_date,
               o_custkey as customer_id,
               case o_orderpriority when '1-URGENT' then lpad(cast(o_custkey as string), 9, '0')
                    when '2-HIGH' then concat('A00', cast(o_custkey as string)) when '3-MEDIUM' then '000'
                    when '5-LOW' then null else cast(o_orderkey as string) end as custom_purchase_order_number,
               cast(null as string) as custom_store_number, 'Reno' as custom_warehouse, o_orderpriority as private_note,
               o_custkey as billing_address_id, o_custkey as shipping_address_id,
               o_orderdate as created_at, o_orderdate as updated_at
        from {orders}""",
    "fin_people": """
        select c_custkey as id, concat(c_mktsegment, ':', c_name) as fully_qualified_name from {customer}
        where c_acctbal > 0""",
    "invoice_lines": """
        select l_orderkey as invoice_id,
               case when l_returnflag = 'R' then null else l_partkey end as sales_item_item_id,
               cast(l_extendedprice as decimal(18,2)) as amount
        from {lineitem}""",
    "fin_items": """
        select p_partkey as id,
               case when p_size > 40 then concat('SKU-', cast(p_partkey as string)) else p_name end as name,
               case when p_size < 20 then concat('SKU-', cast(p_partkey as string))
                    when p_size < 40 then lpad(cast(p_partkey as string), 12, '0') else p_type end as stock_keeping_unit
        from {part}""",
    "estimate_links": "select o_orderkey as invoice_id, o_orderkey + 10000000 as estimate_id from {orders} where o_orderpriority in ('1-URGENT', '2-HIGH')",
    "estimates": "select o_orderkey + 10000000 as id, concat('EST', cast(o_orderkey as string)) as doc_number from {orders} where o_orderstatus <> 'O'",
    "edi_register": """
        select p.p_name as textbox_23,
               case when o_orderstatus = 'P' and o_totalprice < 50000 then null
                    else concat(lpad(cast(month(o_orderdate) as string), 2, '0'), '/', lpad(cast(day(o_orderdate) as string), 2, '0'), '/', cast(year(o_orderdate) as string)) end as textbox_17,
               cast(o_orderkey as string) as textbox_19,
               case o_orderstatus when 'F' then '810-Invoice' when 'O' then '850-Purchase Order' else '997-Acknowledgment' end as textbox_21,
               'inbox' as textbox_15, cast(o_custkey as string) as alt_doc_num,
               case when o_orderpriority = '5-LOW' then '(12.50)'
                    else concat('$', cast(cast(floor(o_totalprice / 1000) as bigint) as string), ',', lpad(cast(cast(floor(o_totalprice) as bigint) % 1000 as string), 3, '0'), '.50') end as txn_amount,
               concat(lpad(cast(month(o_orderdate) as string), 2, '0'), '/', lpad(cast(day(o_orderdate) as string), 2, '0'), '/', cast(year(o_orderdate) as string),
                      case when o_orderstatus = 'O' then ' 12:05:09 AM' when o_orderstatus = 'F' then ' 12:30:00 PM' else ' 07:08:09 PM' end) as stamp,
               concat(substr(cast(cast(o_orderdate as date) as string), 1, 7), '.csv') as _file,
               o_orderkey as _line, o_orderdate as _modified, o_orderdate as _fivetran_synced
        from {orders} o join {part} p on p.p_partkey = o.o_custkey""",
    "edi_log": """
        select textbox_23 as edipartner_name, textbox_21 as txn_type, textbox_19 as alt_doc_id, alt_doc_num as account_id,
               txn_amount as amount, stamp as document_date,
               case when textbox_17 is null then 'later' else stamp end as log_time,
               textbox_15 as description, _file, _line, _modified, _fivetran_synced
        from {edi_register}""",
    "people": """
        select c_custkey as id,
               case when c_acctbal < 0 then null else lower(concat(c_name, '@shop.example')) end as email,
               c_mktsegment as first_name, c_name as last_name
        from {customer}""",
    "addresses": """
        select c.c_custkey as customer_id, n.n_name as city, lpad(cast(c.c_custkey as string), 5, '0') as zip,
               r.r_name as country,
               case when n.n_nationkey < 10 then 'US' when n.n_nationkey < 15 then 'DE' when n.n_nationkey < 20 then 'GB' else '' end as country_code,
               case n.n_nationkey
                    when 0 then '' when 1 then '555-CALL-NOW' when 2 then '123'
                    else concat(case when n.n_nationkey < 6 then '(212) 555-' when n.n_nationkey < 10 then '+1 212 555 '
                                     when n.n_nationkey < 15 then '030 9555 ' when n.n_nationkey < 20 then '020 7946 ' else '+49 30 9555 ' end,
                                lpad(cast(c.c_custkey % 10000 as string), 4, '0')) end as phone,
               true as is_default
        from {customer} c join {nation} n on n.n_nationkey = c.c_nationkey join {region} r on r.r_regionkey = n.n_regionkey
        union all
        select c_custkey as customer_id, 'old' as city, '00000' as zip, 'old' as country, 'US' as country_code,
               cast(null as string) as phone, false as is_default
        from {customer} where c_acctbal > 5000""",
}
