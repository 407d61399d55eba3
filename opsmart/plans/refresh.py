"""Whole refreshes: the tables of an area, each loaded once those it reads are there.

An area is a list of :class:`Step`, one a table, with the tables it needs. :func:`run_graph` puts the steps in levels,
runs the steps of a level at the same time (their Spark jobs share the cluster), and goes on when one fails: what needs the failed table,
directly or not, is skipped, everything else is finished. A failed step leaves its table as it was
(:mod:`opsmart.sources.store`). ``raw`` holds the raw frames by feed name; ``store`` keeps the curated tables; tables that a step needs
and no step of the run makes have to be in the store already.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from opsmart.operators.load import LoadStats
from opsmart.plans import ads, audience, bom, edi, feeds, finance, inventory, purchasing, shop, sku
from opsmart.schemas import schema
from opsmart.sources.store import TableStore
from opsmart.sources.tables import empty


@dataclass(frozen=True)
class Step:
    table: str
    run: Callable[[], object]
    needs: tuple[str, ...] = ()


@dataclass(frozen=True)
class Outcome:
    """``status`` is done, failed or skipped; ``report`` what the step returned, ``reason`` why there is none."""

    table: str
    level: int
    status: str
    report: object = None
    reason: str = ""
    error: Exception | None = None

    @property
    def rows(self) -> int | None:
        """Rows that the step wrote: the new ones of a load, all of a rewritten table, none of one that did not change."""
        r = self.report
        if isinstance(r, LoadStats):
            return r.new
        if isinstance(r, tuple):
            changed, n = r
            return n if changed else 0
        return r if isinstance(r, int) else None


def levels(steps: Sequence[Step]) -> list[list[Step]]:
    """Steps by the longest way to them; a step's needs all lie in earlier levels, or outside."""
    left = {s.table: s for s in steps}
    if len(left) < len(steps):
        raise ValueError("two steps make the same table")
    out: list[list[Step]] = []
    while left:
        ready = [s for s in left.values() if not any(n in left for n in s.needs)]
        if not ready:
            raise ValueError("tables need each other: " + ", ".join(sorted(left)))
        out.append(ready)
        for s in ready:
            del left[s.table]
    return out


def run_graph(steps: Sequence[Step], at_once: int = 4) -> dict[str, Outcome]:
    """Run all steps, level by level and ``at_once`` at a time; never raises for a step that fails."""
    done: dict[str, Outcome] = {}

    def run(step: Step, level: int) -> Outcome:
        missing = [n for n in step.needs if n in done and done[n].status != "done"]
        if missing:
            return Outcome(step.table, level, "skipped", reason="without " + ", ".join(missing))
        try:
            return Outcome(step.table, level, "done", report=step.run())
        except Exception as e:  # whatever a job raises; it is kept and reported
            return Outcome(step.table, level, "failed", reason=str(e).splitlines()[0], error=e)

    with ThreadPoolExecutor(at_once) as pool:
        for k, level in enumerate(levels(steps)):
            found = list(pool.map(lambda s, k=k: run(s, k), level))
            done.update((o.table, o) for o in found)
    return done


def reports(outcomes: Mapping[str, Outcome]) -> dict[str, object]:
    """What each step reported; raises the first error there was, after everything else has been done."""
    for o in outcomes.values():
        if o.error is not None:
            raise o.error
    return {o.table: o.report for o in outcomes.values()}


def summary(spark: SparkSession, store: TableStore, outcomes: Mapping[str, Outcome]) -> DataFrame:
    """``table, level, status, rows_written, rows_total`` of a run."""
    rows = [(o.table, o.level, o.status, o.rows, store.read(o.table).count() if store.exists(o.table) else 0) for o in outcomes.values()]
    return spark.createDataFrame(rows, "table string, level int, status string, rows_written long, rows_total long")


def tidy(store: TableStore, outcomes: Mapping[str, Outcome]) -> None:
    """Drop what a run has superseded, so that a store holds each table once, however many runs there were.
    Frames read before must be done with. Tables of steps that failed or were skipped stay as they are."""
    for o in outcomes.values():
        if o.status == "done" and store.exists(o.table):
            store.vacuum(o.table)


def refresh_in_order(steps: dict) -> dict:
    """Call the steps one after the other and stop at the first error; returns
    what each one reported. Order is the dependency order of the tables."""
    return {name: step() for name, step in steps.items()}


# ---- areas -------------------------------------------------------------------


def _loader(store: TableStore, table: str, batch: Callable[[], DataFrame], needs: Sequence[str] = ()) -> Step:
    policy, order = feeds.POLICY[table]
    return Step(table, lambda: store.load(table, batch(), latest=policy, order=order), tuple(needs))


def _rewritten(store: TableStore, table: str, content: Callable[[], DataFrame], needs: Sequence[str] = ()) -> Step:
    """A table that is made anew each time."""

    def run() -> LoadStats:
        before = store.read(table).count() if store.exists(table) else 0
        n = store.full_refresh(table, content()).count()
        return LoadStats(n, before, n)

    return Step(table, run, tuple(needs))


def warehouse_steps(store: TableStore, raw: Mapping[str, DataFrame], brand: str) -> list[Step]:
    """Order lines, the register that reads them, and both stock reports."""
    lines = "wms_transaction_lines"
    return [
        _loader(store, lines, lambda: feeds.parse_transaction_lines(raw[lines])),
        _loader(
            store, "wms_transaction_register",
            lambda: feeds.parse_transaction_register(raw["wms_transaction_register"], store.read(lines)), [lines],
        ),
        _loader(store, "wms_inventory", lambda: feeds.parse_inventory(raw["wms_inventory"])),
        _loader(store, "wms_inventory_history", lambda: feeds.parse_inventory_history(raw["wms_inventory_history"], brand)),
    ]


def logistics_steps(store: TableStore, raw: Mapping[str, DataFrame], stock_prefix: str, shipment_prefix: str) -> list[Step]:
    """Stock and shipments of the third-party warehouse."""
    return [
        _loader(store, "3pl_inventory", lambda: feeds.parse_3pl_inventory(raw["3pl_inventory"], stock_prefix)),
        _loader(store, "3pl_shipment", lambda: feeds.parse_3pl_shipment(raw["3pl_shipment"], shipment_prefix)),
    ]


def stock_steps(store: TableStore, raw: Mapping[str, DataFrame], names: tuple[str, str] = ("Reno", "North")) -> list[Step]:
    """The map of warehouse SKUs, and the stock history as intervals: reports that come late split what is stored."""

    def warehouse_map() -> LoadStats:
        fresh = raw["warehouse_mapping"].filter(~F.col("match") & F.col("sku_ref").isNotNull())
        return store.load("warehouse_map", fresh.select(F.col("sku").alias("warehouse_sku"), "sku_ref"), "warehouse_sku", "keep")

    def history() -> LoadStats:
        own = store.read("wms_inventory_history").withColumn("inv_date", F.col("inv_run"))
        other = store.read("3pl_inventory").select(
            "sku", "sku_name", F.col("quantity_on_hand").alias("on_hand"), F.col("quantity_allocated").alias("on_hold"),
            F.col("quantity_available").alias("available"), F.col("report_date").alias("inv_date"),
        )
        sources = [
            inventory.Feed(own, names[0], patterns=inventory.SKU_TYPE_PATTERNS, name_from_feed=False),
            inventory.Feed(other, names[1], default_type="Component"),
        ]
        found = inventory.stock_snapshots(sources, store.read("warehouse_map"), store.read("sku_master"))
        if not store.exists("inventory_history"):
            full = inventory.inventory_intervals(sources, store.read("warehouse_map"), store.read("sku_master"))
            n = store.write("inventory_history", full).count()
            return LoadStats(n, 0, n)
        stored = store.read("inventory_history")
        before = stored.count()
        # Snapshots that are new, or say something else than the stored ones.
        said = stored.select(*inventory.ITEM, "inv_date", *[F.col(f"seen_{c}").alias(c) for c in inventory.MEASURES])
        changed = found.select(said.columns).subtract(said).select(*inventory.ITEM, "inv_date")
        late = found.join(changed, [*inventory.ITEM, "inv_date"], "left_semi")
        if late.isEmpty():
            return LoadStats(0, before, before)
        after = store.write("inventory_history", inventory.repair_inventory(stored, late)).count()
        return LoadStats(after - before, before, after)

    return [
        Step("warehouse_map", warehouse_map),
        Step("inventory_history", history, ("warehouse_map", "wms_inventory_history", "3pl_inventory", "sku_master")),
    ]


def purchasing_steps(store: TableStore, raw: Mapping[str, DataFrame]) -> list[Step]:
    """Status map, vendor map, tracker (one batch per sync), average prices."""

    def tracker():
        batch = purchasing.po_tracker(
            raw["po_tracker"], store.read("sku_master"), store.read("vendor_mapping"), store.read("po_status")
        )
        return store.load("po_tracker", batch, latest="max_sync_minute", order="_fivetran_synced")

    def prices():
        new = purchasing.average_price(store.read("po_tracker"), store.read("sku_master"), store.read("brands"))
        return store.append_batch("average_price", new)

    return [
        _rewritten(store, "po_status", lambda: purchasing.po_status(raw["po_statuses"])),
        _rewritten(store, "vendor_mapping", lambda: purchasing.vendor_mapping(raw["po_tracker"], raw["vendor"])),
        Step("po_tracker", tracker, ("sku_master", "vendor_mapping", "po_status")),
        Step("average_price", prices, ("po_tracker", "sku_master", "brands")),
    ]


def reference_steps(store: TableStore, raw: Mapping[str, DataFrame]) -> list[Step]:
    """SKU master and its companions, each replaced only when something changed."""
    made = {
        "sku_master": lambda: sku.sku_master(raw["sku_master"], raw["vendor"]),
        "retail_master": lambda: sku.retail_master(raw["retail_master"]),
        "brands": lambda: raw["brands"],
        "groups": lambda: sku.product_groups(raw["groups"]),
    }
    return [Step(t, lambda t=t, f=f: store.replace_if_changed(t, f())) for t, f in made.items()]


def bom_steps(store: TableStore, raw: Mapping[str, DataFrame]) -> list[Step]:
    """BOM lines: a new flagged batch every time."""
    return [Step("boms", lambda: store.append_batch("boms", bom.bom_enrich(raw["boms"], store.read("sku_master"))), ("sku_master",))]


def edi_steps(store: TableStore, raw: Mapping[str, DataFrame]) -> list[Step]:
    """Partner map, then the register and the integration log."""
    table = "edi_partner_mapping"

    def mapping():
        old = store.read(table) if store.exists(table) else empty(store.spark, schema(table))
        before = old.count()
        after = store.write(table, edi.partner_mapping(raw["fin_customer"], raw["edi_register"], old)).count()
        return LoadStats(after - before, before, after)

    return [
        Step(table, mapping),
        _loader(store, "edi_register", lambda: edi.parse_register(raw["edi_register"], store.read(table)), [table]),
        _loader(store, "edi_integration", lambda: edi.parse_integration(raw["edi_integration"], store.read(table)), [table]),
    ]


def finance_steps(store: TableStore, raw: Mapping[str, DataFrame], day: str = "transaction_date") -> list[Step]:
    """Clones of the ledger with its periods, documents, and the links between invoices and estimates."""
    customers = "finance_customers"
    return [
        _rewritten(store, customers, lambda: raw["fin_customer"]),
        _rewritten(store, "ledger", lambda: finance.ledger_periods(raw["ledger"], day)),
        _rewritten(store, "estimates", lambda: finance.estimates_view(raw["estimates"], store.read(customers)), [customers]),
        _rewritten(store, "invoices", lambda: finance.invoices_view(raw["invoices"], store.read(customers)), [customers]),
        _rewritten(
            store, "invoice_estimate_ref",
            lambda: finance.invoice_estimate_ref(raw["invoices"], raw["estimate_links"], raw["estimates"], store.read(customers)), [customers],
        ),
    ]


def audience_steps(store: TableStore, raw: Mapping[str, DataFrame]) -> list[Step]:
    """Members at their default address, with their numbers in international form, and the list that goes out."""
    return [
        _rewritten(store, "audience", lambda: audience.normalise_phones(audience.audience(raw["customers"], raw["addresses"])).all),
        _rewritten(store, "audience_export", lambda: audience.audience_export(store.read("audience")), ["audience"]),
    ]


AD_REPORTS = ("ad_stats", "account_history", "campaign_history", "ad_group_history", "ad_history")


def ads_steps(store: TableStore, raw: Mapping[str, DataFrame]) -> list[Step]:
    """Clones of the ad reports, the joined table and its summary."""
    clones = [Step(t, lambda t=t: store.snapshot(t, raw[t]).count()) for t in AD_REPORTS]
    return [
        *clones,
        _rewritten(store, "ads_modified", lambda: ads.ads_modified(*[store.read(t) for t in AD_REPORTS]), AD_REPORTS),
        _rewritten(store, "ads_summary", lambda: ads.ads_summary(store.read("ads_modified")), ["ads_modified"]),
    ]


def shop_steps(store: TableStore, raw: Mapping[str, DataFrame]) -> list[Step]:
    """Daily keys of the shop and the reports on them."""
    return [
        _rewritten(store, "daily_shop", lambda: shop.daily_shop_key(raw["daily_shop"])),
        _rewritten(store, "daily_shop_report", lambda: shop.daily_shop_report(raw["spine"], store.read("daily_shop")), ["daily_shop"]),
    ]


def refresh_warehouse(store: TableStore, raw: Mapping[str, DataFrame], brand: str):
    return reports(run_graph(warehouse_steps(store, raw, brand)))


def refresh_purchasing(store: TableStore, raw: Mapping[str, DataFrame]):
    return reports(run_graph(purchasing_steps(store, raw)))


def refresh_sku_reference(store: TableStore, raw: Mapping[str, DataFrame]):
    return reports(run_graph(reference_steps(store, raw)))


def refresh_boms(store: TableStore, raw: Mapping[str, DataFrame]):
    return reports(run_graph(bom_steps(store, raw)))


def refresh_edi(store: TableStore, raw: Mapping[str, DataFrame]):
    return reports(run_graph(edi_steps(store, raw)))
