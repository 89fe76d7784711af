"""The three jobs: item catalogue, ledger load, derived figures.

Each takes tables and returns new tables; a caller publishes them as a new version, so that a run is seen
as a whole or not at all. Staging tables stand where several later steps read a result.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfbook.config import FIRST_OUTLET, LedgerConfig, Window
from shelfbook.operators import activity as act
from shelfbook.operators import adjust, ages, inbound, items, maintain, sequence, windows
from shelfbook.session import durable
from shelfbook.sources.tables import Sources, publish_version


def item_catalogue(
    sources: Sources,
    config: LedgerConfig,
    run_ts: datetime,
    current: DataFrame | None = None,
    elsewhere: DataFrame | None = None,
) -> DataFrame:
    """The Items table of one population; ``elsewhere`` holds items left to another population."""
    if config.not_in_population and elsewhere is None:
        raise ValueError(f"the items of {config.not_in_population!r} are needed")
    pm, pmd = sources["product_master"], sources["product_master_dist"]
    excluded = durable(items.excluded_items(pm, sources["base_inventory"], config.exclude))
    base = items.select_items(pm, excluded, config.items, run_ts, elsewhere)
    links = items.expand_links(items.seed_links(pm, pmd, base, excluded), pm, pmd)
    named = items.canonical_item(items.repair_parent(links), pm)
    named = items.apply_overrides(named, items.override_table(pm.sparkSession, config.overrides))
    incoming = durable(items.enrich_items(named, pm, pmd))
    maintain.assert_unique(incoming, ["item_code"], "items")
    if current is None:
        current = incoming.withColumn("last_update", F.lit(None).cast("timestamp_ntz")).limit(0)
    return items.upsert_items(current, incoming, run_ts)


@dataclass(frozen=True)
class Load:
    """Result of a ledger load."""

    detail: DataFrame
    ledger: DataFrame
    shape: sequence.Shape


def active_stores(locations: DataFrame, before: str) -> DataFrame:
    """Active locations that are stores proper."""
    return locations.filter((F.col("location_no") < before) & (F.col("status") == "A"))


def _staged_inbound(sources: Sources, config, item_rows, window, fresh, stores) -> DataFrame:
    warehouse = [
        (sources[f"wms_detail{part}"], sources[f"wms_header{part}"])
        for part in ("", "_archive1", "_archive2")
        if f"wms_detail{part}" in sources
    ]
    typed = [detail for detail, _ in warehouse[: 1 + config.archives_in_order_types]]
    categories = durable(inbound.order_categories(*typed))
    push = inbound.warehouse_push(warehouse, item_rows, categories, window, fresh)
    ships = durable(
        inbound.shipment_detail(
            sources["shipment_detail"], sources["shipment_header"], push, sources["dropship_cutoff"],
            item_rows, window, fresh, stores,
        )
    )
    receipts = durable(
        inbound.combine_receipts(
            *[
                inbound.receipt_detail(
                    sources[f"receive_header{part}"], sources[f"receive_detail{part}"], item_rows, window, fresh,
                    historical=bool(part), stores=stores,
                )
                for part in ("", "_hist")
            ]
        )
    )
    staged = durable(
        inbound.stage_inbound(
            inbound.match_ship_receive(ships, receipts),
            inbound.shipment_rollup(ships),
            inbound.receipt_rollup(receipts),
            sources["transit_times"],
        )
    )
    repeated = staged.filter(F.col("dups") > 1).select(*inbound.DETAIL_KEY).limit(5).collect()
    if repeated:
        raise ValueError(f"staged inbound: repeated keys, e.g. {[tuple(r) for r in repeated]}")
    return staged


def _activity(sources: Sources, item_rows, window, fresh, stores) -> DataFrame:
    common = {"items": item_rows, "window": window, "fresh": fresh, "stores": stores}
    market = [sources[n] for n in ("market_order", "facility", "fulfil_header", "fulfil_detail")]
    web = [sources[n] for n in ("web_order", "facility")]
    pm = sources["product_master"]
    return act.online_union(
        act.store_sales(sources["sales_item"], sources["sales_header"], sources["locations"], **common),
        act.marketplace_sales(*market, product_master=pm, **common),
        act.marketplace_refunds(*market, product_master=pm, **common),
        act.web_sales(*web, product_master=pm, **common),
        act.web_refunds(*web, product_master=pm, **common),
        act.transfers_out(sources["transfer_detail"], **common),
        act.counts(sources["store_count"], "SICC", **common),
        act.counts(sources["centre_count"], "CICC", **common),
    )


def load_ledger(
    sources: Sources,
    config: LedgerConfig,
    item_rows: DataFrame,
    detail: DataFrame,
    ledger: DataFrame,
    as_of: datetime,
    window: Window | None = None,
    limit: int = sequence.RUN_LIMIT,
) -> Load:
    """One load: inbound detail and ledger brought up to date, in order and with segment markers.

    ``window`` replaces the configured one, for a rerun by hand.
    """
    window = window or windows.load_window(config.window_policy, as_of, ledger)
    stores = active_stores(sources["locations"], FIRST_OUTLET) if config.active_stores_only else None
    fresh = durable(windows.new_items(item_rows, ledger))
    staged = _staged_inbound(sources, config, item_rows, window, fresh, stores)
    received = durable(inbound.apply_receipts(detail, staged, as_of))
    derived = durable(inbound.derive_inbound(inbound.refresh_shipment_totals(received, as_of)))
    next_detail = durable(inbound.insert_inbound(derived, staged, as_of))
    consolidated = act.consolidate(_activity(sources, item_rows, window, fresh, stores), item_rows)
    rows = maintain.sync_inbound(ledger.select(*maintain.LEDGER_COLUMNS), next_detail, as_of)
    rows = maintain.append_inbound(durable(rows), next_detail, item_rows, as_of)
    rows = durable(maintain.append_activity(durable(rows), consolidated, as_of))
    maintain.assert_unique(rows, act.LEDGER_KEY, "ledger")
    shape = sequence.Shape.of(rows, limit)
    ordered = sequence.sequence_ledger(rows, shape)
    return Load(next_detail, sequence.mark_segments(ordered, shape), shape)


def derived_figures(
    ledger: DataFrame, config: LedgerConfig, shape: sequence.Shape | None = None
) -> tuple[DataFrame, DataFrame]:
    """Count adjustments and ages, rebuilt from the whole ledger (a stored table)."""
    shape = shape or sequence.Shape.of(ledger)
    adjustments = shape.store(adjust.set_adjustments(ledger, shape))
    result = ages.ages(ledger, adjustments, shape)
    if not config.item_in_key:
        adjustments, result = adjust.set_adjustments(ledger, shape, item_in_key=False), result.drop("item")
    return adjustments, result


def rebuild_figures(
    ledger: DataFrame, config: LedgerConfig, folder: str, version: str, shape: sequence.Shape | None = None
) -> dict[str, DataFrame]:
    """``adjustments`` and ``ages`` of the whole ledger, published together as one version and read back."""
    adjustments, result = derived_figures(ledger, config, shape)
    return publish_version({"adjustments": adjustments, "ages": result}, folder, version)
