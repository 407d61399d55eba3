"""Exact and fuzzy matching, BOM enrichment, sequence numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsmart.operators import load, match, ranking
from opsmart.operators.fuzzy import fuzzy_best_match
from opsmart.plans import edi, inventory, purchasing, sku
from registry import query

# ---- exact ----------------------------------------------------------------


@query(
    "lookup_chain",
    """select i.id, coalesce(a.sku, b.sku, c.sku) as ref_sku, coalesce(a.sku_name, b.sku_name, c.sku_name) as ref_name
    from {fin_items} i left join {sku_known} a on a.sku = i.stock_keeping_unit
    left join {sku_known} b on b.upc = i.stock_keeping_unit left join {sku_known} c on c.sku = i.name""",
)
def _(s):
    chain = [("stock_keeping_unit", "sku"), ("stock_keeping_unit", "upc"), ("name", "sku")]
    out = match.lookup_chain(s.fin_items, s.sku_known, chain, {"sku": "ref_sku", "sku_name": "ref_name"})
    return out.select("id", "ref_sku", "ref_name")


def _audited(s):
    """Stock rows with a UPC that is right for some items and missing for others."""
    return s.sql(
        """select sku, sku_name, case when on_hold < 3 then lpad(replace(sku, 'SKU-', ''), 12, '0') end as upc from {tpl_snapshots}"""
    )


_AUDIT = """select distinct e.sku, e.sku_name, e.upc, a.sku is not null as sku_matched, a.sku_name as ref_sku_name, b.upc is not null as upc_matched
    from (select sku, sku_name, case when on_hold < 3 then lpad(replace(sku, 'SKU-', ''), 12, '0') end as upc from {tpl_snapshots}) e
    left join {sku_known} a on a.sku = e.sku left join {sku_known} b on b.upc = e.upc"""


@query("match_audit", _AUDIT)
def _(s):
    return match.match_audit(_audited(s), s.sku_known, ["sku", "sku_name", "upc"])


@query(
    "match_coverage",
    f"""with a as ({_AUDIT}) select count(*) as total_rows,
        count(*) filter (sku_matched) as sku_matched_rows, count(*) filter (sku_matched) / cast(count(*) as double) * 100 as sku_matched_pct,
        count(*) filter (upc_matched) as upc_matched_rows, count(*) filter (upc_matched) / cast(count(*) as double) * 100 as upc_matched_pct from a""",
)
def _(s):
    audit = match.match_audit(_audited(s), s.sku_known, ["sku", "sku_name", "upc"])
    return match.share_matched(audit, ["sku_matched", "upc_matched"])


@query(
    "remap_key",
    """select coalesce(m.sku_ref, w.sku) as sku, sum(on_hand) as on_hand, count(*) as n from {wms_snapshots} w
    left join (select sku as alias, sku_ref from {warehouse_mapping} where sku_ref is not null) m on m.alias = w.sku group by 1""",
)
def _(s):
    mapping = s.warehouse_mapping.filter("sku_ref is not null")
    out = match.remap_key(s.wms_snapshots, mapping.withColumnRenamed("sku", "alias"), "sku", "alias", "sku_ref")
    return out.groupBy("sku").agg(F.sum("on_hand").alias("on_hand"), F.count("*").alias("n"))


@query(
    "role_enrich",
    """select b.fg_sku, b.component_sku, b._line, c.sku_name as component_name, f.sku_name as fg_name, f.upc as fg_upc
    from {bom_raw} b left join {sku_known} c on c.sku = b.component_sku left join {sku_known} f on f.sku = b.fg_sku""",
)
def _(s):
    roles = {"component_sku": {"sku_name": "component_name"}, "fg_sku": {"sku_name": "fg_name", "upc": "fg_upc"}}
    return match.enrich_roles(s.bom_raw.select("fg_sku", "component_sku", "_line"), s.sku_known, "sku", roles)


@query(
    "scalar_attach",
    """select o_orderkey, date_diff('day', cast(o_orderdate as date), cast((select max(o_orderdate) from {orders}) as date)) as days_before_last from {orders}""",
)
def _(s):
    out = load.attach_max(s.orders, F.col("o_orderdate").cast("date"), "last_day")
    days = F.date_diff("last_day", F.col("o_orderdate").cast("date")).cast("bigint")
    return out.select("o_orderkey", days.alias("days_before_last"))


@query(
    "semi_and_anti",
    """select 'semi' as kind, count(*) as n from {part} where p_partkey in (select l_partkey from {lineitem} where l_quantity > 49)
    union all select 'anti', count(*) from {part} p where not exists (select 1 from {lineitem} l where l_quantity > 49 and l.l_partkey = p.p_partkey)""",
)
def _(s):
    sold = s.lineitem.filter("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    parts = [
        s.part.join(sold, "p_partkey", how).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
        for kind, how in (("semi", "left_semi"), ("anti", "left_anti"))
    ]
    return parts[0].union(parts[1])


@query(
    "current_records",
    "select ad_id, ad_name from {ad_history} where is_most_recent_record",
)
def _(s):
    return match.current_records(s.ad_history).select("ad_id", "ad_name")


@query(
    "first_per_key",
    """select o_custkey, o_orderkey, o_orderdate from (select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as rn from {orders}) where rn = 1""",
)
def _(s):
    return match.first_per_key(s.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderdate")


@query(
    "sequence_in_group",
    """select o_orderpriority, o_orderkey, row_number() over (partition by o_orderpriority order by o_orderstatus, o_orderdate, o_orderkey) as position,
        row_number() over (partition by nullif(o_orderstatus, 'P') order by o_orderdate, o_orderkey) - 1 as index from {orders}""",
)
def _(s):
    """Three huge groups, numbered without sorting any of them in one task."""
    out = ranking.sequence_in_group(s.orders, ["o_orderpriority"], ["o_orderstatus", "o_orderdate", "o_orderkey"], "position")
    out = out.withColumn("g", F.nullif(F.col("o_orderstatus"), F.lit("P")))
    out = ranking.sequence_in_group(out, ["g"], ["o_orderdate", "o_orderkey"], "index", start=0)
    return out.select("o_orderpriority", "o_orderkey", "position", "index")


# ---- fuzzy: the counterpart compares every name with every name -----------

_SCORE = "cast(floor(100 * jaro_winkler_similarity(lower({0}), lower({1})) + 1e-9) as integer)"


def _brute(left: str, right: str, lcol: str, rcol: str, order: str) -> str:
    score = _SCORE.format(f"l.{lcol}", f"r.{rcol}")
    return f"""l as (select distinct {lcol} from ({left})), r as ({right}),
        pairs as (select l.{lcol}, r.*, {score} as similarity from l, r where {score} >= 85),
        best as (select *, row_number() over (partition by {lcol} order by similarity desc, {order}) as row_num,
                 rank() over (partition by {lcol} order by similarity desc) as place from pairs)"""


@query(
    "fuzzy_best_match",
    f"""with {_brute("select concat(p_brand, ' ', p_name) as po_name from {part}", "select id, display_name from {fin_customers} where display_name not like '%Brand#7'", "po_name", "display_name", "id, display_name")}
    select l.po_name, b.id, b.display_name, b.similarity, 1 as row_num from l left join (select * from best where row_num = 1) b on b.po_name = l.po_name""",
)
def _(s):
    names = s.part.select(F.concat("p_brand", F.lit(" "), "p_name").alias("po_name"))
    right = s.fin_customers.select("id", "display_name")
    return fuzzy_best_match(names, right, "po_name", "display_name", exclude="%Brand#7")


@query(
    "fuzzy_with_ties",
    f"""with {_brute("select trim(ship_to) as po_name from {po_raw} where ship_to <> 'N/A' union select trim(ship_from) from {po_raw} where ship_from <> 'N/A'",
                     "select display_name, print_on_check_name, id from {vendors} where display_name not like '%(deleted)%'", "po_name", "display_name", "display_name, print_on_check_name, id")}
    select l.po_name, b.display_name as qb_name, print_on_check_name as qb_check_name, id, l.po_name as tc_name, similarity, coalesce(cast(row_num as integer), 1) as row_num
    from l left join (select * from best where place = 1) b on b.po_name = l.po_name""",
)
def _(s):
    return purchasing.vendor_mapping(s.po_raw, s.vendors)


@query(
    "fuzzy_cross",
    f"""with {_brute("select textbox_23 as tc_name from {edi_register}", "select display_name, id, fully_qualified_name from {fin_customers}", "tc_name", "display_name", "display_name, id, fully_qualified_name")}
    select id as qb_id, display_name as qb_name, fully_qualified_name as qb_fq_name, tc_name from best where row_num = 1""",
)
def _(s):
    return edi.best_partners(s.fin_customers, s.edi_register)


@query(
    "partner_mapping",
    f"""with {_brute("select textbox_23 as tc_name from {edi_register}", "select display_name, id, fully_qualified_name from {fin_customers}", "tc_name", "display_name", "display_name, id, fully_qualified_name")},
    t as (select id as qb_id, display_name as qb_name, fully_qualified_name as qb_fq_name, 'stored' as tc_name from {{fin_customers}} where display_name like '%Brand#1%')
    select * from t union all select id, display_name, fully_qualified_name, tc_name from best where row_num = 1 and id not in (select qb_id from t)""",
)
def _(s):
    stored = s.fin_customers.filter("display_name like '%Brand#1%'").select(
        F.col("id").alias("qb_id"), F.col("display_name").alias("qb_name"),
        F.col("fully_qualified_name").alias("qb_fq_name"), F.lit("stored").alias("tc_name"),
    )
    return edi.partner_mapping(s.fin_customers, s.edi_register, stored)


_DIRTY_VENDOR = "case when p_size = 13 then null when p_type = 'SMALL' then upper(p_name) else replace(p_name, 'o', '0') end"


def _master_raw(s):
    numbers = ["unit_width", "unit_height", "unit_length", "carton_height", "carton_width", "carton_length", "carton_weight"]
    nulls = ["class", "country", "dimensions_units", "weight_units", "notes"]
    raw = s.sql(
        f"""select sku, sku_name, upc, brand, status, product_code, product_group, sku_type, version, {_DIRTY_VENDOR} as vendor, unit,
            case when p_size > 25 then 'n/a' else cast(p_size as string) end as eaches_per_carton, timestamp '2023-01-01 00:00:00' as _fivetran_synced
        from {{sku_master}} m join {{part}} p on m.sku = concat('SKU-', cast(p.p_partkey as string))"""
    )
    return raw.withColumns({**{c: F.lit(1.5) for c in numbers}, **{c: F.lit("x") for c in nulls}})


@query(
    "sku_master",
    f"""with {_brute("select " + _DIRTY_VENDOR + " as vendor from {part}", "select display_name, id from {vendors} where display_name not like '%(deleted)%'", "vendor", "display_name", "display_name, id")}
    select m.sku, p.vendor, b.id as vendor_id, try_cast(p.eaches as bigint) as eaches_per_carton
    from {{sku_master}} m join (select p_partkey, {_DIRTY_VENDOR} as vendor, case when p_size > 25 then 'n/a' else cast(p_size as varchar) end as eaches from {{part}}) p
    on m.sku = concat('SKU-', cast(p.p_partkey as varchar)) left join (select * from best where row_num = 1) b on b.vendor = p.vendor""",
)
def _(s):
    return sku.sku_master(_master_raw(s), s.vendors).select("sku", "vendor", "vendor_id", "eaches_per_carton")


@query(
    "retail_master",
    """select sku, p_type as retailer, p_brand as retailer_sku, upc, p_retailprice as srp, 0.1::double as retail_discount, p_retailprice as retail_srp
    from {sku_master} m join {part} p on m.sku = concat('SKU-', cast(p.p_partkey as varchar))""",
)
def _(s):
    raw = s.sql(
        """select sku as sku_sold_to_retailer, p_type as retailer, p_brand as retailer_sku, upc, p_retailprice as srp,
            cast(0.1 as double) as retail_discount, p_retailprice as retail_srp
        from {sku_master} m join {part} p on m.sku = concat('SKU-', cast(p.p_partkey as string))"""
    )
    return sku.retail_master(raw)


@query("product_groups", "select group_id, group_name, product_type from {groups}")
def _(s):
    return sku.product_groups(s.groups)


@query("finished_goods", "select sku, sku_name, sku_type from {sku_master} where sku_type = 'Finished Good'")
def _(s):
    return sku.finished_goods(s.sku_master).select("sku", "sku_name", "sku_type")


@query(
    "warehouse_sku_match",
    """with a as (select *, row_number() over (partition by sku order by on_hand, inv_date, on_hold, sku_name) as rn from {wms_snapshots}),
    b as (select *, row_number() over (partition by sku order by inv_date, on_hand, on_hold, sku_name) as rn from {tpl_snapshots}), u as (
    select 'Reno' as warehouse, sku, sku_name, cast(null as varchar) as upc, cast(null as varchar) as sku_description from a where rn = 1
    union all select 'North', sku, sku_name, null, null from b where rn = 1)
    select u.*, k.sku is not null as match, k.sku as sku_ref from u left join {sku_known} k on k.sku = u.sku""",
)
def _(s):
    blank = F.lit(None).cast("string")
    feeds = [
        ("Reno", s.wms_snapshots.withColumn("upc", blank), ["on_hand", "inv_date", "on_hold"]),
        ("North", s.tpl_snapshots.withColumn("upc", blank), ["inv_date", "on_hand", "on_hold"]),
    ]
    return inventory.warehouse_sku_match(feeds, s.sku_known)


@query(
    "warehouse_map",
    """select sku as warehouse_sku, upc as sku_ref from {sku_master} where product_group = 'MEDIUM'
    union all select sku, sku_ref from {warehouse_mapping} where not match and sku_ref is not null
        and sku not in (select sku from {sku_master} where product_group = 'MEDIUM')""",
)
def _(s):
    stored = s.sku_master.filter("product_group = 'MEDIUM'").select(F.col("sku").alias("warehouse_sku"), F.col("upc").alias("sku_ref"))
    return inventory.warehouse_map(s.warehouse_mapping, stored)
