"""Refreshes of several areas in dependency order, with what every round wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsmart.plans import refresh
from opsmart.session import shared_dir
from opsmart.sources.store import TableStore
from registry import REGISTRY, query
from registry.inventory import shipments_raw

#: Raw rows of the first round.
_EARLY = "_line % 3 <> 0"
_AD_VIEWS = dict(zip(refresh.AD_REPORTS, ["ad_stats", "account_history", "campaign_history", "ad_group_history", "ad_history"], strict=True))


def _raw(s, early: bool, broken: bool) -> dict:
    some = (lambda df: df.where(_EARLY)) if early else (lambda df: df)
    lines = some(s.line_report)
    if broken:
        lines = lines.withColumn("materials", F.raise_error(F.lit("unreadable report")).cast("string"))
    return {
        "wms_transaction_lines": lines, "wms_transaction_register": some(s.register_raw), "wms_inventory": some(s.wms_report),
        "wms_inventory_history": some(s.wms_report), "3pl_inventory": some(s.tpl_report), "3pl_shipment": some(shipments_raw(s)),
        "fin_customer": s.fin_people, "ledger": s.invoices, "estimates": s.invoices, "invoices": s.invoices, "estimate_links": s.estimate_links,
        "customers": s.people, "addresses": s.addresses, **{t: getattr(s, v) for t, v in _AD_VIEWS.items()},
    }


def _counts() -> dict[str, tuple[int, str, str]]:
    """table -> level, and SQL for its rows in the first round and later."""

    def loaded(key: str, view: str) -> tuple[str, str]:
        text = REGISTRY[key].sql
        return text.replace(f"{{{view}}}", f"(select * from {{{view}}} where {_EARLY})"), text

    def same(text: str) -> tuple[str, str]:
        return text, text

    def of(key: str) -> tuple[str, str]:
        return same(REGISTRY[key].sql)

    found = {
        "wms_transaction_lines": (0, *loaded("txn_lines", "line_report")),
        "wms_transaction_register": (1, *loaded("txn_register", "register_raw")),
        "wms_inventory": (0, *loaded("wms_inventory", "wms_report")),
        "wms_inventory_history": (0, *loaded("wms_inventory_history", "wms_report")),
        "3pl_inventory": (0, *loaded("tpl_inventory", "tpl_report")),
        "3pl_shipment": (0, *loaded("tpl_shipment", "register_raw")),
        "finance_customers": (0, *same("select * from {fin_people}")),
        "ledger": (0, *same("select * from {invoices}")),
        "estimates": (1, *of("estimates_view")),
        "invoices": (1, *of("invoices_view")),
        "invoice_estimate_ref": (1, *of("invoice_estimate_ref")),
        "audience": (0, *of("audience_default_address")),
        "audience_export": (1, *of("audience_export")),
        **{t: (0, *same(f"select * from {{{v}}}")) for t, v in _AD_VIEWS.items()},
        "ads_modified": (1, *of("ads_modified")),
        "ads_summary": (2, *of("ads_summary")),
    }
    return found


def _sql() -> str:
    counts = _counts()
    loads = {t for t in counts if t.startswith(("wms_", "3pl_"))}  # of these, a row id counts once
    size = {t: "count(distinct _row_id)" if t in loads else "count(*)" for t in counts}
    ctes = [f"c{i} as (select (select {size[t]} from ({a})) as early, (select {size[t]} from ({b})) as n)" for i, (t, (_, a, b)) in enumerate(counts.items())]
    rows = []
    for i, (table, (level, _, _)) in enumerate(counts.items()):
        fate = {"wms_transaction_lines": "failed", "wms_transaction_register": "skipped"}.get(table, "done")
        written = ("early", "n - early", "0" if fate == "done" else "null") if table in loads else ("n", "n", "n")
        for k, (w, total, status) in enumerate(zip(written, ("early", "n", "n"), ("done", "done", fate), strict=True), 1):
            rows.append(f"select {k}, '{table}', {level}, '{status}', cast({w} as bigint), cast({total} as bigint) from c{i}")
    return f"with {', '.join(ctes)}, r(round, \"table\", level, status, rows_written, rows_total) as ({' union all '.join(rows)}) select * from r"


@query("refresh_rounds", _sql())
def _(s):
    """Two refreshes, and one in which the order lines cannot be read: what needs them waits, the rest is refreshed."""
    store = TableStore(s.spark, shared_dir(s.spark, "refresh"))
    shown = None
    for number, (early, broken) in enumerate([(True, False), (False, False), (False, True)], 1):
        raw = _raw(s, early, broken)
        steps = [
            *refresh.warehouse_steps(store, raw, "Brand"), *refresh.logistics_steps(store, raw, "stock_report_", "ship_"),
            *refresh.finance_steps(store, raw), *refresh.audience_steps(store, raw), *refresh.ads_steps(store, raw),
        ]
        outcomes = refresh.run_graph(steps)
        outcome = refresh.summary(s.spark, store, outcomes).select(F.lit(number).alias("round"), "*")
        refresh.tidy(store, outcomes)
        shown = outcome if shown is None else shown.union(outcome)
    return shown
