"""Sales, finance, EDI and audiences."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsmart.operators import load, quality
from opsmart.plans import audience, edi, finance, sales
from registry import query
from registry.text import _AMOUNT, slash, us_stamp

_ID = "sha256(_file || '-' || cast(_line as varchar)) as _row_id"


def _double(df, *columns):
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


@query(
    "shop_ref_mapping",
    """select shop_id, shop_name, k.sku as ref_sku, k.sku_name as ref_sku_name
    from (select distinct sku, name as shop_name, product_id as shop_id from {shop_lines}) i left join {sku_known} k on k.sku = i.sku""",
)
def _(s):
    return sales.shop_ref_mapping(s.shop_lines, s.sku_known)


@query(
    "d2c_sales",
    """select l.sku, k.sku_name, cast(o.processed_timestamp as date) as date_purchased, l.quantity
    from {shop_orders} o join {shop_lines} l on l.order_id = o.order_id join {sku_known} k on k.sku = l.sku""",
)
def _(s):
    return sales.d2c_sales(s.shop_orders, s.shop_lines, s.sku_known)


_MAPPING = """im as (select i.id as qb_id, i.name as qb_name, coalesce(a.sku, b.sku, c.sku) as ref_sku, coalesce(a.sku_name, b.sku_name, c.sku_name) as ref_sku_name
    from {fin_items} i left join {sku_known} a on a.sku = i.stock_keeping_unit left join {sku_known} b on b.upc = i.stock_keeping_unit left join {sku_known} c on c.sku = i.name)"""


@query("item_ref_mapping", f"with {_MAPPING} select * from im")
def _(s):
    return sales.item_ref_mapping(s.fin_items, s.sku_known)


@query(
    "retail_sales",
    f"""with {_MAPPING}, h as (select l.sales_item_item_id as qb_id, i.name as qb_sku_name, d.transaction_date as date_purchased, cast(l.amount as double) as amount
        from {{invoices}} d left join {{invoice_lines}} l on l.invoice_id = d.id left join {{fin_items}} i on i.id = l.sales_item_item_id)
    select ref_sku, qb_sku_name, coalesce(ref_sku_name, qb_sku_name) as sku_name, date_purchased, amount from h left join im on im.qb_id = h.qb_id where h.qb_id is not null""",
)
def _(s):
    mapping = sales.item_ref_mapping(s.fin_items, s.sku_known)
    return _double(sales.retail_sales(s.invoices, s.invoice_lines, s.fin_items, mapping), "amount")


@query("unmapped_lines", "select invoice_id, cast(amount as double) as amount from {invoice_lines} where sales_item_item_id is null")
def _(s):
    return _double(sales.unmapped_lines(s.invoice_lines), "amount").select("invoice_id", "amount")


_DOC = """id as qb_id, currency_id as currency, cast(total_amount as double) as total_amount, ship_date, transaction_date, customer_id,
    c.fully_qualified_name as customer, custom_purchase_order_number as po_number,
    case when regexp_full_match(custom_purchase_order_number, '[0-9]+') then ltrim(custom_purchase_order_number, '0') else custom_purchase_order_number end as po_number_trim,
    custom_store_number as store_number, custom_warehouse as warehouse, private_note as memo, billing_address_id, shipping_address_id, created_at, updated_at
    from {invoices} d left join (select id as cid, fully_qualified_name from {fin_people}) c on c.cid = d.customer_id"""


@query("estimates_view", f"select doc_number as estimate_id, transaction_status, {_DOC}")
def _(s):
    return _double(finance.estimates_view(s.invoices, s.fin_people), "total_amount")


@query("invoices_view", f"select doc_number as invoice_id, {_DOC}")
def _(s):
    return _double(finance.invoices_view(s.invoices, s.fin_people), "total_amount")


@query(
    "invoice_estimate_ref",
    """select i.doc_number as invoice_id, i.id as qb_invoice_id, e.doc_number as estimate_id, l.estimate_id as qb_estimate_id, c.fully_qualified_name as customer, i.customer_id
    from {invoices} i left join {fin_people} c on c.id = i.customer_id left join {estimate_links} l on l.invoice_id = i.id
    left join {estimates} e on e.id = l.estimate_id where i.doc_number is not null""",
)
def _(s):
    return finance.invoice_estimate_ref(s.invoices, s.estimate_links, s.estimates, s.fin_people)


@query(
    "ledger_periods",
    """select id, transaction_date, cast(date_trunc('month', transaction_date) as date) as period_first_day, last_day(transaction_date) as period_last_day from {invoices}""",
)
def _(s):
    return finance.ledger_periods(s.invoices.select("id", "transaction_date"), "transaction_date")


@query(
    "budget",
    """select o_orderkey as line, o_custkey as account_id, r_regionkey as budget_id, c_mktsegment as account_class, r_name as budget_name, c_name as account_name,
        c_mktsegment as account_type, cast(o_orderdate as date) as period_first_day, last_day(cast(o_orderdate as date)) as period_last_day
    from {orders} join {customer} on c_custkey = o_custkey join {nation} on n_nationkey = c_nationkey join {region} on r_regionkey = n_regionkey where c_acctbal > 0""",
)
def _(s):
    detail = s.sql(
        """select o_orderkey as line, o_custkey as account_id, n_regionkey as budget_id, cast(o_orderdate as date) as budget_date
        from {orders} join {customer} on c_custkey = o_custkey join {nation} on n_nationkey = c_nationkey"""
    )
    budgets = s.sql("select r_regionkey as id, r_name as name from {region}")
    accounts = s.sql("select c_custkey as id, c_name as name, c_mktsegment as classification, c_mktsegment as account_type from {customer} where c_acctbal > 0")
    return finance.budget(detail, budgets, accounts)


_ALIKE = "cast(floor(100 * jaro_winkler_similarity(lower(t.tc_name), lower(c.display_name)) + 1e-9) as integer)"
_PARTNERS = f"""scored as (select t.tc_name, c.id, {_ALIKE} as similarity, row_number() over (partition by t.tc_name order by c.display_name, c.id, c.fully_qualified_name) as place
            from (select distinct textbox_23 as tc_name from {{edi_register}}) t, {{fin_customers}} c where {_ALIKE} >= 85),
        chosen as (select tc_name, arg_max(id, (similarity, -place)) as qb_id from scored group by tc_name),
        single as (select qb_id, tc_name from chosen)"""


def _partners(s):
    """Each trading partner's customer by similarity, stored first, as the refresh does."""
    return s.stored("partner-map", lambda: edi.best_partners(s.fin_customers, s.edi_register))


@query(
    "edi_register",
    f"""with {_PARTNERS} select sha256(textbox_23 || '-' || textbox_17 || '-' || textbox_19) as transaction_id, _line + 1 as index, textbox_23 as trading_partner,
        m.qb_id as trading_partner_qb_id, substr(textbox_21, 5) as transaction_type, left(textbox_21, 3) as transaction_type_id, textbox_19 as doc_number,
        alt_doc_num as alt_doc_number, {_AMOUNT.format('txn_amount')} as amount, {slash('textbox_17')} as creation_date, textbox_15 as folder,
        cast(date_trunc('month', {slash('textbox_17')}) as date) as period_first_day, last_day({slash('textbox_17')}) as period_last_day, true as latest, {_ID}
    from {{edi_register}} r left join single m on m.tc_name = r.textbox_23 where textbox_23 is not null and textbox_17 is not null and textbox_19 is not null""",
)
def _(s):
    return edi.parse_register(s.edi_register, _partners(s)).drop("_modified", "_file", "_fivetran_synced")


@query(
    "edi_integration",
    f"""with {_PARTNERS} select sha256(edipartner_name || '-' || document_date || '-' || alt_doc_id) as transaction_id, _line + 1 as index, edipartner_name as trading_partner,
        m.qb_id as trading_partner_qb_id, txn_type as transaction_type, alt_doc_id as alt_doc_number, account_id as tc_account_id, {_AMOUNT.format('amount')} as amount,
        {us_stamp('document_date')} as document_date, {us_stamp('log_time')} as log_time, description,
        cast(date_trunc('month', {us_stamp('document_date')}) as date) as period_first_day, last_day({us_stamp('document_date')}) as period_last_day, true as latest, {_ID}
    from {{edi_log}} r left join single m on m.tc_name = r.edipartner_name""",
)
def _(s):
    out = edi.parse_integration(s.edi_log, _partners(s)).drop("_modified", "_file", "_fivetran_synced")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("document_date", "log_time")})


_KEYED = "(textbox_23 || '-' || textbox_17 || '-' || textbox_19)"


@query(
    "edi_quality",
    f"""with ids as (select {_KEYED} as id, textbox_17, {slash('textbox_17')} as day from {{edi_register}} where {_KEYED} is not null),
    logged as (select edipartner_name || '-' || document_date || '-' || alt_doc_id as id from {{edi_log}})
    select 'edi_register unique(transaction_id)' as "check", count(*) as failures, count(*) = 0 as passed from (select id from ids group by id having count(*) > 1)
    union all select 'edi_register not_null(transaction_id)', count(*) - count(id), count(*) = count(id) from ids
    union all select 'edi_register not_null(creation_date)', count(*) - count(day), count(*) = count(day) from ids
    union all select 'edi_integration unique(transaction_id)', count(*), count(*) = 0 from (select id from logged where id is not null group by id having count(*) > 1)
    union all select 'edi_integration not_null(transaction_id)', count(*) - count(id), count(*) = count(id) from logged""",
)
def _(s):
    """Checks of the curated EDI tables; lines whose date cannot be read are counted, not lost."""
    register = edi.parse_register(s.edi_register, _partners(s))
    log = edi.parse_integration(s.edi_log, _partners(s))
    checks = [
        (name, check(df, column))
        for name, df, check, column in (
            ("edi_register", register, quality.unique_check, "transaction_id"),
            ("edi_register", register, quality.not_null_check, "transaction_id"),
            ("edi_register", register, quality.not_null_check, "creation_date"),
            ("edi_integration", log, quality.unique_check, "transaction_id"),
            ("edi_integration", log, quality.not_null_check, "transaction_id"),
        )
    ]
    rows = [df.withColumn("check", F.concat(F.lit(f"{name} "), "check")) for name, df in checks]
    return load.union_sources(*rows)


@query(
    "edi_chain",
    f"""with {_PARTNERS}
    select textbox_23 as trading_partner, m.qb_id as trading_partner_qb_id, count(*) as n_lines, cast(sum(cast({_AMOUNT.format('txn_amount')} as decimal(18,2))) as double) as amount, min({slash('textbox_17')}) as first_day
    from {{edi_register}} r left join single m on m.tc_name = r.textbox_23 where textbox_23 is not null and textbox_17 is not null and textbox_19 is not null group by all""",
)
def _(s):
    """Partners matched by similarity, and the register built on that map, summed by partner."""
    register = edi.parse_register(s.edi_register, _partners(s))
    return register.groupBy("trading_partner", "trading_partner_qb_id").agg(
        F.count("*").alias("n_lines"), F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("amount"), F.min("creation_date").alias("first_day")
    )


_MEMBERS = """mb as (select c.id, email, first_name, last_name, city, zip, country, country_code, phone from {people} c
    join {addresses} a on a.customer_id = c.id where email is not null and is_default)"""


@query("audience_default_address", f"with {_MEMBERS} select * from mb")
def _(s):
    return audience.audience(s.people, s.addresses)


@query("audience_export", f"with {_MEMBERS} select email, first_name, last_name, zip, country_code as country, phone from mb")
def _(s):
    return audience.audience_export(audience.audience(s.people, s.addresses))


# The address view writes five kinds of numbers: US national and international,
# German and British national, German international; plus blanks and junk.
_PHONES = f"""{_MEMBERS}, ph as (select *, regexp_replace(phone, '[^0-9]', '', 'g') as d from mb),
    np as (select *, case when phone = '' or phone = '123' or regexp_matches(phone, '[A-Za-z]') then null
        when phone like '(212)%' then '+1' || d when phone like '+%' then '+' || d
        when country_code = 'DE' then '+49' || substr(d, 2) when country_code = 'GB' then '+44' || substr(d, 2) end as e164 from ph)"""


@query("phone_normalise", f"with {_PHONES} select id, country_code, phone as raw, e164 as phone from np")
def _(s):
    members = audience.audience(s.people, s.addresses)
    out = audience.normalise_phones(members.withColumn("raw", F.col("phone"))).all
    return out.select("id", "country_code", "raw", "phone")


@query("phone_changed", f"with {_PHONES} select id, e164 as phone from np where e164 is not null")
def _(s):
    return audience.normalise_phones(audience.audience(s.people, s.addresses)).changed


@query("phone_counts", f"with {_PHONES} select count(e164) as parsed, count(*) filter (phone <> '' and e164 is null) as failed, count(*) filter (phone = '') as blank from np")
def _(s):
    return audience.normalise_phones(audience.audience(s.people, s.addresses)).counts
