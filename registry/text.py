"""Cleaning of SKUs, amounts, dates, PO numbers and phones."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsmart.functions import dates, numbers, phone, sku, text
from registry import query

# The rules, on lists. A SKU is cut at its mark into head and tail, the tail at its slashes into bin and UPC; an unmarked SKU has
# no tail, so whatever comes from the tail is null. Squeezing splits a text at what has to go and joins the rest.
def cut(table: str) -> str:
    """CTE ``bits``: the rows of ``table`` with the pieces that the expressions below are made of."""
    return f"""cut as (select *, string_split(sku, 'SKU#:') as halves, array_to_string(string_split(item_description, 'DELETED'), '') as item from {{{table}}}),
    bits as (select *, string_split(halves[1], '/')[1] as head, halves[2] as tail, string_split(halves[2], '/') as segments from cut)"""


_CUT = cut("dirty_items")


def _without(text: str, pattern: str) -> str:
    return f"array_to_string(regexp_split_to_array({text}, '{pattern}'), '')"


_BLANK = r"\s"
_GONE = r"-DELETE|[.\s]"
_SQUEEZED = _without("sku", _GONE)
_HISTORY_SKU = f"if(tail is null, coalesce(nullif({_SQUEEZED}, ''), if(sku[1] = '.', '', sku)), {_without('head', _GONE)})"
_CURRENT_SKU = f"""if(tail is not null, {_without('head', ' ')}, if(sku[1] = '.' or sku[-7:] = '-DELETE',
    array_to_string(string_split(if(sku[1] = '.', sku[2:], sku), '-DELETE'), ''), sku))"""
_BIN = ".{{3}}-.{{2}}"
_HISTORY_UPC = f"""coalesce(nullif({_without('segments[2]', _BLANK)}, ''),
    if(regexp_matches({_without('tail', _BLANK)}, '{_BIN}'), null, {_without('tail', _BLANK)}))"""
_CURRENT_UPC = "coalesce(segments[2], tail[:0])"
_HISTORY_PLACE = f"coalesce(qualifier, nullif(regexp_extract(item, '^({_BIN}) ', 1), ''), if(regexp_matches(sku, '{_BIN}'), segments[1], null))"
_CURRENT_PLACE = "segments[1]"
_NAME = f"""if(regexp_matches(item, '^{_BIN}'), if(length(item) < 7, item, item[8:]),
    array_to_string([upper(w[1]) || lower(w[2:]) for w in string_split(item, ' ')], ' '))"""


@query(
    "clean_sku",
    f"""with {_CUT} select p_partkey, sku as raw, {_HISTORY_SKU} as history_form, {_CURRENT_SKU} as current_form,
        trim({_without('sku', '-DELETE|[.]')}) as line_form, sku[:11] = 'MISC SUPPLY' as misc_supply from bits""",
)
def _(s):
    raw = F.col("sku")
    return s.dirty_items.select(
        "p_partkey", raw.alias("raw"), sku.clean_sku_history(raw).alias("history_form"),
        sku.clean_sku_current(raw).alias("current_form"), sku.clean_sku_line(raw).alias("line_form"),
        sku.is_misc_supply(raw).alias("misc_supply"),
    )


@query(
    "extract_upc_location",
    f"""with {_CUT} select p_partkey, {_HISTORY_UPC} as upc_history, {_CURRENT_UPC} as upc_current, {_HISTORY_PLACE} as location_history,
        {_CURRENT_PLACE} as location_current, {_NAME} as item_name from bits""",
)
def _(s):
    raw, item = F.col("sku"), F.col("item_description")
    return s.dirty_items.select(
        "p_partkey", sku.upc_history(raw).alias("upc_history"), sku.upc_current(raw).alias("upc_current"),
        sku.location_history(raw, F.col("qualifier"), item).alias("location_history"),
        sku.location_current(raw).alias("location_current"), sku.item_name(item).alias("item_name"),
    )


_AMOUNT = "try_cast(replace(replace({0}, '$', ''), ',', '') as double)"


@query(
    "parse_money",
    f"""select textbox_19 as doc, txn_amount, {_AMOUNT.format('txn_amount')} as amount,
        cast(round({_AMOUNT.format('txn_amount')}) as bigint) as whole,
        try_cast(textbox_19 as bigint) as doc_number, try_cast(txn_amount as decimal(38,0)) as junk from {{edi_register}}""",
)
def _(s):
    amount = F.col("txn_amount")
    return s.edi_register.select(
        F.col("textbox_19").alias("doc"), "txn_amount", numbers.parse_amount(amount).alias("amount"),
        numbers.parse_count(amount).alias("whole"), numbers.parse_int(F.col("textbox_19")).alias("doc_number"),
        numbers.parse_wide_integer(amount).alias("junk"),
    )


_SLASH = """case when regexp_full_match({0}, '[0-9]{{{{1,2}}}}/[0-9]{{{{1,2}}}}/[0-9]{{{{2}}}}') then try_cast('20' || split_part({0}, '/', 3) || '-' || split_part({0}, '/', 1) || '-' || split_part({0}, '/', 2) as date)
    when regexp_full_match({0}, '[0-9]{{{{1,2}}}}/[0-9]{{{{1,2}}}}/[0-9]{{{{4}}}}') then try_cast(split_part({0}, '/', 3) || '-' || split_part({0}, '/', 1) || '-' || split_part({0}, '/', 2) as date) end"""
_US = "try_strptime({0}, '%m/%d/%Y %I:%M:%S %p')"


def slash(column: str) -> str:
    return _SLASH.replace("{0}", column).replace("{{{{", "{{").replace("}}}}", "}}")


def us_stamp(column: str) -> str:
    return _US.format(column)


@query(
    "parse_dates",
    f"""select _line, {slash('date')} as txn_date, {slash("replace(ship_date, '- CAN', '')")} as ship_date,
        ship_date like '%-CAN%' or ship_date like '%- CAN%' as cancelled,
        try_cast(left(cast(cast(_modified as date) as varchar), 10) as date) as iso_date,
        coalesce(last_day(cast(_modified as date)) = cast(_modified as date), false) as month_end,
        last_day(cast(_modified as date)) as month_last, cast(date_trunc('month', _modified) as date) as month_first,
        cast(substr(_file, 1, 4) || '-01-01' as date) as file_date
    from {{register_raw}}""",
)
def _(s):
    day = F.col("_modified").cast("date")
    return s.register_raw.select(
        "_line",
        dates.parse_slash_date(F.col("date")).alias("txn_date"),
        dates.parse_slash_date(text.without_cancel_mark(F.col("ship_date"))).alias("ship_date"),
        text.is_cancelled(F.col("ship_date")).alias("cancelled"),
        dates.leading_date(day).alias("iso_date"),
        dates.is_month_end(day).alias("month_end"),
        F.last_day(day).alias("month_last"),
        dates.month_start(day).alias("month_first"),
        dates.report_date(F.concat(F.lit("stock_"), F.substring("_file", 1, 4), F.lit("-01-01_x.csv")), "stock_").alias("file_date"),
    )


@query("parse_timestamps", f"select _line, stamp, {us_stamp('stamp')} as parsed, {us_stamp('textbox_15')} as junk from {{edi_register}}")
def _(s):
    return s.edi_register.select(
        "_line", "stamp", dates.parse_us_timestamp(F.col("stamp")).cast("timestamp_ntz").alias("parsed"),
        dates.parse_us_timestamp(F.col("textbox_15")).cast("timestamp_ntz").alias("junk"),
    )


@query(
    "po_number_trim",
    """select id, custom_purchase_order_number as po_number,
        case when regexp_full_match(custom_purchase_order_number, '[0-9]+') then ltrim(custom_purchase_order_number, '0')
             else custom_purchase_order_number end as po_number_trim from {invoices}""",
)
def _(s):
    po = F.col("custom_purchase_order_number")
    return s.invoices.select("id", po.alias("po_number"), text.strip_leading_zeros(po).alias("po_number_trim"))


@query("serial_dates", "select o_orderkey, date '1899-12-30' + cast(30000 + o_custkey as integer) as day from {orders}")
def _(s):
    return s.orders.select("o_orderkey", dates.serial_date(F.col("o_custkey") + 30000).alias("day"))


@query("txn_type_split", "select _line, left(textbox_21, 3) as code, substr(textbox_21, 5) as label from {edi_register}")
def _(s):
    kind = F.col("textbox_21")
    return s.edi_register.select("_line", text.code_of(kind).alias("code"), text.label_of(kind).alias("label"))


@query("null_sentinels", "select p_partkey, nullif(nullif(upper(p_type), ''), 'LARGE') as p_type, nullif(p_brand, 'Brand#7') as p_brand from {part}")
def _(s):
    return s.part.select(
        "p_partkey", text.blank_to_null(F.upper("p_type"), "LARGE").alias("p_type"),
        text.blank_to_null(F.col("p_brand"), "Brand#7").alias("p_brand"),
    )


@query("like_and_regex", """select o_orderkey, o_orderpriority like '_-%' as dashed, o_orderpriority not like '%LOW' as not_low,
    o_orderpriority ilike '%high%' as high, regexp_full_match(o_orderpriority, '[0-9]-[A-Z]+') as one_word from {orders}""")
def _(s):
    p = F.col("o_orderpriority")
    return s.orders.select(
        "o_orderkey", p.like("_-%").alias("dashed"), (~p.like("%LOW")).alias("not_low"),
        text.any_ilike(p, ["%high%"]).alias("high"), text.full_match(p, "[0-9]-[A-Z]+").alias("one_word"),
    )


# Phones written anywhere in the documents, over their whole text.
_PHONE = r"\+1 \([0-9]{{3}}\) [0-9]{{3}}-[0-9]{{4}}"


@query(
    "phone_e164",
    f"""select doc_id, raw, case when substr(d, 1, 1) = '1' and length(d) = 11 then '+' || d end as phone
    from (select doc_id, raw, regexp_replace(raw, '[^0-9]', '', 'g') as d
          from (select doc_id, unnest(regexp_extract_all(text, '{_PHONE}')) as raw from {{documents}}))""",
)
def _(s):
    pattern = _PHONE.replace("{{", "{").replace("}}", "}")
    found = s.documents.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("raw"))
    return found.withColumn("phone", phone.e164(F.col("raw"), F.lit("US")))


# A phone for each customer, written as at home or from abroad, in regions of every zone of the numbering plan.
_REGIONS = {
    "US": "1 1", "BD": "880 0", "AM": "374 0", "BG": "359 0", "DE": "49 0", "FR": "33 0", "GB": "44 0", "IT": "39", "ES": "34", "PT": "351",
    "PL": "48", "CZ": "420", "HU": "36 06", "RU": "7 8", "BY": "375 8", "EG": "20 0", "NG": "234 0", "SN": "221", "ZM": "260 0", "BO": "591 0",
    "GT": "502", "UY": "598 0", "NP": "977 0", "KH": "855 0", "SG": "65", "UZ": "998 0",
}
_PHONES = "select c_custkey, ['" + "', '".join(_REGIONS) + f"'][1 + c_custkey % {len(_REGIONS)}] as region, cast(200000000 + c_custkey * 7 as varchar) as number, c_custkey % 4 as form from {{customer}}"
_PLAN = ", ".join(f"('{r}', '{x.split()[0]}', '{(x.split() + [''])[1]}')" for r, x in _REGIONS.items())


@query(
    "phone_regions",
    f"""with p as ({_PHONES}), plan(region, code, trunk) as (values {_PLAN}),
    written as (select c_custkey, region, code, if(region = 'US', '2' || number, number) as national, form, trunk from p join plan using (region))
    select c_custkey, region, case form when 0 then trunk || national when 1 then '+' || code || ' ' || national
            when 2 then '+999 ' || national else '+' || code || '-' || left(national, 3) || '-' || substr(national, 4) end as raw,
        if(form = 2, null, '+' || code || national) as phone from written""",
)
def _(s):
    """National form, two international ones, and an unassigned code, which gives NULL."""
    plan = {r: (x.split()[0], (x.split() + [""])[1]) for r, x in _REGIONS.items()}
    regions = F.array(*map(F.lit, plan))
    lookup = lambda k: F.create_map(*[F.lit(x) for r, v in plan.items() for x in (r, v[k])])
    made = s.customer.select(
        "c_custkey", F.element_at(regions, (1 + F.col("c_custkey") % len(plan)).cast("int")).alias("region"),
        (200000000 + F.col("c_custkey") * 7).cast("string").alias("number"), (F.col("c_custkey") % 4).alias("form"),
    )
    national = F.when(F.col("region") == "US", F.concat(F.lit("2"), "number")).otherwise(F.col("number"))
    code, trunk = F.element_at(lookup(0), F.col("region")), F.element_at(lookup(1), F.col("region"))
    raw = (
        F.when(F.col("form") == 0, F.concat(trunk, national))
        .when(F.col("form") == 1, F.concat(F.lit("+"), code, F.lit(" "), national))
        .when(F.col("form") == 2, F.concat(F.lit("+999 "), national))
        .otherwise(F.concat(F.lit("+"), code, F.lit("-"), F.substring(national, 1, 3), F.lit("-"), F.substr(national, F.lit(4))))
    )
    return made.select("c_custkey", "region", raw.alias("raw")).withColumn("phone", phone.e164(F.col("raw"), F.col("region")))
