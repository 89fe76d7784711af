"""Every operator as a named query over whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfbook.config import GENERAL, Window
from shelfbook.functions.clock import moment
from shelfbook.operators import activity as act
from shelfbook.operators import adjust, ages, diagnostics, inbound, items, maintain, merge, sequence, summaries, trace, windows
from shelfbook.plans import pipeline
from shelfbook.session import buckets_for, durable, durable_by, shared_folder, tune
from shelfbook.sources import tables
from shelfbook.sources.standins import Standins

AS_OF = datetime(2001, 12, 31, 12)
FIRST_LOAD, FIRST_RUN = Window(datetime(2005, 1, 1), datetime(2009, 1, 1)), datetime(2009, 1, 1, 6)
SECOND_LOAD, SECOND_RUN = Window(datetime(2008, 6, 1), datetime(2011, 1, 1)), datetime(2011, 1, 1, 6)
POLICY_RUN = datetime(2010, 3, 3, 9)  # a Wednesday
LEDGER_BUCKET = 500_000  # rows of the first load in a bucket of the stored ledger
ONLINE = Window(datetime(2024, 1, 2), datetime(2024, 1, 25))


def shown(df: DataFrame) -> DataFrame:
    """Plain result types: decimals as doubles, days as text, flags as numbers."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.BooleanType):
            column = column.cast("int")
        columns.append(column.alias(field.name))
    return df.select(*columns)


class Work:
    """Intermediate results shared by several queries, each built when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.s = Standins(tune(spark), folder)

    # catalogue

    @cached_property
    def excluded(self) -> DataFrame:
        return durable(items.excluded_items(self.s.product_master, self.s.base_inventory, GENERAL.exclude))

    def base(self) -> DataFrame:
        return items.select_items(self.s.product_master, self.excluded, GENERAL.items, AS_OF)

    def seeds(self) -> DataFrame:
        return items.seed_links(self.s.product_master, self.s.product_master_dist, self.base(), self.excluded)

    def links(self) -> DataFrame:
        return items.expand_links(self.seeds(), self.s.product_master, self.s.product_master_dist)

    def own_links(self) -> DataFrame:
        """Every code with its reporting item."""
        dist = self.s.product_master_dist
        return dist.select(
            "item_code",
            F.coalesce(F.nullif(F.trim("report_item_code"), F.lit("")), F.col("item_code")).alias("rpt_it"),
        )

    def named(self) -> DataFrame:
        return items.canonical_item(items.repair_parent(self.own_links()), self.s.product_master)

    # inbound

    def fresh_items(self) -> DataFrame:
        return windows.new_items(self.s.items, self.s.known_codes)

    @cached_property
    def fresh(self) -> DataFrame:
        """Every source asks for the new items, so they are staged once per load."""
        return durable(self.fresh_items())

    def order_types(self) -> DataFrame:
        return inbound.order_categories(*[detail for detail, _ in self.s.warehouse])

    @cached_property
    def categories(self) -> DataFrame:
        return durable(self.order_types())

    def push(self, window: Window) -> DataFrame:
        return inbound.warehouse_push(self.s.warehouse, self.s.items, self.categories, window, self.fresh)

    def ships(self, window: Window, buckets: int | None = None) -> DataFrame:
        s = self.s
        return inbound.shipment_detail(
            s.shipment_detail, s.shipment_header, self.push(window), s.cutoffs, s.items, window, self.fresh,
            buckets=buckets,
        )

    def live_receipts(self, window: Window) -> DataFrame:
        return inbound.receipt_detail(*self.s.receipts, self.s.items, window, self.fresh)

    def old_receipts(self, window: Window) -> DataFrame:
        return inbound.receipt_detail(*self.s.receipts_hist, self.s.items, window, self.fresh, historical=True)

    def receipts(self, window: Window, buckets: int | None = None) -> DataFrame:
        return inbound.combine_receipts(self.live_receipts(window), self.old_receipts(window), buckets=buckets)

    @cached_property
    def dealt(self) -> int:
        """Buckets of the tables that lie by shipment."""
        return buckets_for(self.s.spark, self.s.spark.read.parquet(f"{self.s.folder}/lineitem.parquet").count())

    def by_shipment(self, rows: DataFrame, key=("loc", "shpmt")) -> DataFrame:
        """A staging table that lies by shipment and, within it, by code, as its roll-ups and matches read it."""
        return durable_by(rows, key, self.dealt, ["item_code"])

    def deal(self, rows: DataFrame, key=("loc", "shpmt")) -> DataFrame:
        return self.by_shipment(rows.repartition(self.dealt, *key), key)

    def staged(self, window: Window) -> DataFrame:
        # Each side is read by its roll-up and by the match.
        ships = self.by_shipment(self.ships(window, self.dealt), inbound.SHIPMENT)
        receipts = self.by_shipment(self.receipts(window, self.dealt), inbound.SHIPMENT)
        return inbound.stage_inbound(
            inbound.match_ship_receive(ships, receipts),
            inbound.shipment_rollup(ships),
            inbound.receipt_rollup(receipts),
            self.s.transit,
        )

    @cached_property
    def first_detail(self) -> DataFrame:
        staged = self.deal(self.staged(FIRST_LOAD))
        empty = staged.withColumns({**inbound.derived_columns(True), "last_update": moment(FIRST_RUN)})
        return inbound.insert_inbound(empty.filter("false").select(*inbound.DETAIL_COLUMNS), staged, FIRST_RUN)

    def applied(self) -> DataFrame:
        return inbound.apply_receipts(self.first_detail, self.second_staged, SECOND_RUN)

    @cached_property
    def second_staged(self) -> DataFrame:
        return self.deal(self.staged(SECOND_LOAD))

    def refreshed(self) -> DataFrame:
        return inbound.refresh_shipment_totals(self.by_shipment(self.applied()), SECOND_RUN)

    def derived(self) -> DataFrame:
        return inbound.derive_inbound(self.refreshed())

    def second_detail(self) -> DataFrame:
        return inbound.insert_inbound(self.by_shipment(self.derived()), self.second_staged, SECOND_RUN)

    # activity

    def sales(self, window: Window) -> DataFrame:
        s = self.s
        return act.store_sales(s.sales_item, s.sales_header, s.locations, s.items, window, self.fresh)

    def market(self, operator) -> DataFrame:
        s = self.s
        return operator(
            s.market_order, s.facilities, s.fulfil_header, s.fulfil_detail, s.items, s.product_master, ONLINE, self.fresh
        )

    def web(self, operator) -> DataFrame:
        s = self.s
        return operator(s.web_order, s.facilities, s.items, s.product_master, ONLINE, self.fresh)

    def online(self) -> DataFrame:
        return act.online_union(
            self.market(act.marketplace_sales),
            self.market(act.marketplace_refunds),
            self.web(act.web_sales),
            self.web(act.web_refunds),
        )

    def counted(self) -> DataFrame:
        s = self.s
        return act.counts(s.count_adjustment(False), "SICC", s.items, SECOND_LOAD, self.fresh).unionByName(
            act.counts(s.count_adjustment(True), "CICC", s.items, SECOND_LOAD, self.fresh)
        )

    def item_names(self) -> DataFrame:
        return self.s.items.select("item_code", "item")

    def sales_ledger(self) -> DataFrame:
        first = act.consolidate(self.sales(FIRST_LOAD), self.item_names())
        return first.withColumn("last_update", moment(FIRST_RUN)).select(*maintain.LEDGER_COLUMNS)

    def inbound_ledger(self) -> DataFrame:
        return maintain.append_inbound(
            self.sales_ledger(), self.first_detail, self.item_names(), FIRST_RUN
        )

    def every_source(self) -> DataFrame:
        """The activity of all sources in the second load. The registers ring up an even quantity in two lines."""
        s = self.s
        lines = self.sales(SECOND_LOAD).withColumn("lines", F.expr("CASE WHEN qty % 2 = 0 THEN 2 ELSE 1 END"))
        halves = {c: F.expr(f"{c} div lines") for c in ("qty", "md_qty")}
        halves |= {c: F.expr(f"CAST({c} / lines AS {act.MONEY})") for c in ("sld_val", "md_sld_val")}
        rung = lines.withColumns(halves).withColumn("line", F.explode(F.expr("sequence(1, lines)"))).drop("lines", "line")
        moved = act.transfers_out(s.transfer_detail, s.items, SECOND_LOAD, self.fresh)
        return act.online_union(rung, self.online(), moved, self.counted())

    def all_consolidated(self) -> DataFrame:
        return act.consolidate(self.every_source(), self.item_names())

    @cached_property
    def before_load(self) -> tuple[DataFrame, sequence.Shape]:
        """The ledger of the first load."""
        rows = durable(self.inbound_ledger())
        shape = sequence.Shape.of(rows)
        return sequence.order_runs(rows, shape), shape

    @cached_property
    def old_adjustments(self) -> DataFrame:
        ledger, shape = self.before_load
        return shape.store(adjust.set_adjustments(ledger, shape))

    @cached_property
    def merged(self) -> tuple[merge.LedgerStore, merge.Merged]:
        """The ledger of the first load, stored in buckets, after the second load of all sources."""
        store = merge.LedgerStore(self.s.spark, f"{shared_folder(self.s.spark)}/ledger-{uuid.uuid4().hex}", buckets=max(16, -(-self.before_load[1].rows // LEDGER_BUCKET)))
        store.write(self.before_load[0])
        # The load meets the detail three times by a key that holds that of the shipment.
        detail, activity = self.by_shipment(self.second_detail()), durable(self.all_consolidated())
        return store, merge.merge_load(store, detail, activity, self.item_names(), SECOND_RUN)

    def refreshed_adjustments(self) -> DataFrame:
        return merge.refresh_adjustments(*self.merged, self.old_adjustments)

    def refreshed_ages(self) -> DataFrame:
        ledger, shape = self.before_load
        before = durable(ages.ages(ledger, self.old_adjustments, shape))
        return merge.refresh_ages(*self.merged, durable(self.refreshed_adjustments()), before)

    @cached_property
    def summary(self) -> DataFrame:
        """Cells of the first load, brought up to date by the second."""
        return durable(summaries.refresh_cells(*self.merged, durable(summaries.cells(self.before_load[0]))))

    def summary_by_store(self) -> dict[str, DataFrame]:
        return {"first": self.summary.filter("loc <= '00002'"), "second": self.summary.filter("loc > '00002'")}

    @cached_property
    def with_returned_lots(self) -> tuple[DataFrame, DataFrame, sequence.Shape]:
        """The ledger with returns as lots that take units away again, and its adjustments."""
        turned = F.when(F.col("xacn") == "Rtrn", -F.col("qty")).otherwise(F.col("qty"))
        rows = durable(self.consolidated().withColumn("qty", turned))
        shape = sequence.Shape.of(rows)
        ledger = sequence.order_runs(rows, shape)
        return ledger, adjust.set_adjustments(ledger, shape), shape

    def rebuilt(self) -> dict[str, DataFrame]:
        """Adjustments and ages of the stored ledger, as a reader finds them after a rebuild."""
        ledger, shape = self.stored
        folder = f"{shared_folder(self.s.spark)}/figures-{uuid.uuid4().hex}"
        pipeline.rebuild_figures(ledger, GENERAL, folder, "1", shape)
        return tables.read_version(self.s.spark, folder)

    # ledger

    def consolidated(self) -> DataFrame:
        return act.consolidate(self.s.activity, self.s.all_items)

    @cached_property
    def shaped(self) -> tuple[DataFrame, sequence.Shape]:
        """The ledger rows as a table, before they are put in order."""
        rows = durable(self.consolidated())
        return rows, sequence.Shape.of(rows)

    def sequenced(self) -> DataFrame:
        return sequence.sequence_ledger(*self.shaped)

    def ledger(self) -> tuple[DataFrame, sequence.Shape]:
        rows, shape = self.shaped
        return sequence.mark_segments(sequence.sequence_ledger(rows, shape), shape), shape

    @cached_property
    def stored(self) -> tuple[DataFrame, sequence.Shape]:
        """The ledger as a table, as the steps that derive from it read it."""
        rows, shape = self.shaped
        return sequence.order_runs(rows, shape), shape

    def adjustments(self) -> DataFrame:
        return adjust.set_adjustments(*self.stored)

    def adjusted(self) -> tuple[DataFrame, DataFrame, sequence.Shape]:
        ledger, shape = self.stored
        return ledger, self.adjustments(), shape

    def dated(self) -> DataFrame:
        """The ledger with a time of loading: the day after, or two days after for returns."""
        wait = "CASE WHEN flow = 'in' THEN 2 ELSE 1 END"
        return self.consolidated().selectExpr("*", f"ts + make_dt_interval({wait}, 6) AS last_update")

    def by_store(self) -> dict[str, DataFrame]:
        """Two ledgers: the locations of one group, and all others."""
        dated = self.dated()
        return {"first": dated.filter("loc <= '00002'"), "second": dated.filter("loc > '00002'")}


def _load_window(w: Work) -> DataFrame:
    window = windows.load_window("since_last_update", AS_OF, w.dated())
    return w.s.spark.range(1).select(
        moment(window.start).alias("start_ts"), moment(window.end).alias("end_ts")
    )


def _in_window(w: Work) -> DataFrame:
    rows = windows.in_window(w.s.sales_item, "business_date", SECOND_LOAD, w.fresh)
    return rows.groupBy("item_code", "business_date").agg(
        F.count(F.lit(1)).alias("num_rows"), F.sum("quantity").alias("quantity")
    )


def _by_policy(policy: str) -> Callable[[Work], DataFrame]:
    """The sales that a load with one of the fixed window policies takes."""

    def run(w: Work) -> DataFrame:
        rows = windows.in_window(w.s.sales_item, "business_date", windows.load_window(policy, POLICY_RUN), w.fresh)
        return rows.groupBy("item_code", "business_date").agg(
            F.count(F.lit(1)).alias("num_rows"), F.sum("quantity").alias("quantity")
        )

    return run


def _ages(w: Work) -> DataFrame:
    ledger, adjustments, shape = w.adjusted()
    return ages.ages(ledger, adjustments, shape)


def _traced(operator) -> Callable[[Work], DataFrame]:
    def run(w: Work) -> DataFrame:
        ledger, adjustments, shape = w.adjusted()
        return operator(ledger, shape.store(adjustments), shape.store(trace.closing_rows(ledger)), shape)

    return run


def _remaining(w: Work) -> DataFrame:
    ledger, adjustments, shape = w.adjusted()
    lots = trace.expand_lots(ledger, adjustments, trace.closing_rows(ledger), shape)
    kept = [c for p, _ in ages.VARIANTS for c in (f"{p}septa", f"ru_{p}septa", f"a_{p}septa")]
    return trace.fifo_remaining(lots, shape).select("loc", "item", "u", "d_in_u", "in_qty", *kept)


def _shown_lots(ledger: DataFrame, adjustments: DataFrame, shape: sequence.Shape) -> DataFrame:
    """The lots on hand before or after every sale, transfer or disposal."""
    chosen = shape.store(ledger.filter("flow = 'out'").select("loc", "item", "u"))
    lots = trace.lots_on_hand(ledger, shape.store(adjustments), chosen, shape)
    kept = [c for p, _ in ages.VARIANTS for c in (f"{p}septa", f"ru_{p}septa", f"a_{p}septa")]
    return lots.select("loc", "item", "u", "lot_u", "d_in_u", "in_qty", "in_age", *kept)


def _on_hand(w: Work) -> DataFrame:
    return _shown_lots(*w.adjusted())


def _ages_negative_lots(w: Work) -> DataFrame:
    ledger, adjustments, shape = w.with_returned_lots
    return ages.ages(ledger, shape.store(adjustments), shape)


def age_report(ledger: DataFrame, adjustments: DataFrame, shape: sequence.Shape) -> DataFrame:
    """Per location: units sold with a known age and their mean age, and the median stock age seen."""
    result = ages.ages(ledger, adjustments, shape)
    sold = F.col("flow") == "out"
    return result.groupBy("loc").agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.sum(F.when(sold, -F.col("qty"))).alias("units_out"),
        F.sum(F.when(sold, F.col("qty_days"))).alias("qty_days"),
        F.sum(F.when(sold, F.col("faj_qty_days"))).alias("faj_qty_days"),
        F.max("m_inv_age").alias("oldest_median_age"),
    )


def _age_report(w: Work) -> DataFrame:
    return age_report(*w.adjusted())


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("pct_adj", "f_pct_adj")})


BUILDERS: dict[str, Callable[[Work], DataFrame]] = {
    "excluded_items": lambda w: w.excluded,
    "select_items": Work.base,
    "seed_links": Work.seeds,
    "expand_links": Work.links,
    "repair_parent": lambda w: items.repair_parent(w.own_links()),
    "canonical_item": Work.named,
    "apply_overrides": lambda w: items.apply_overrides(w.named(), w.s.overrides),
    "enrich_items": lambda w: items.enrich_items(w.named(), w.s.product_master, w.s.product_master_dist),
    "upsert_items": lambda w: items.upsert_items(w.s.catalogue(False), w.s.catalogue(True), SECOND_RUN),
    "load_window": _load_window,
    "new_items": Work.fresh_items,
    "in_window": _in_window,
    "in_window_two_days": _by_policy("two_days"),
    "in_window_last_week": _by_policy("last_week"),
    "order_categories": Work.order_types,
    "warehouse_push": lambda w: w.push(SECOND_LOAD),
    "shipment_detail": lambda w: w.ships(SECOND_LOAD),
    "shipment_rollup": lambda w: inbound.shipment_rollup(w.ships(SECOND_LOAD)),
    "receipt_detail": lambda w: w.live_receipts(SECOND_LOAD),
    "receipt_detail_historical": lambda w: w.old_receipts(SECOND_LOAD),
    "receipt_combine": lambda w: w.receipts(SECOND_LOAD),
    "receipt_rollup": lambda w: inbound.receipt_rollup(w.receipts(SECOND_LOAD)),
    "match_ship_receive": lambda w: inbound.match_ship_receive(w.ships(SECOND_LOAD), w.receipts(SECOND_LOAD)),
    "stage_inbound": lambda w: w.staged(SECOND_LOAD),
    "apply_receipts": Work.applied,
    "refresh_shipment_totals": Work.refreshed,
    "derive_inbound": Work.derived,
    "insert_inbound": Work.second_detail,
    "store_sales": lambda w: w.sales(SECOND_LOAD),
    "marketplace_sales": lambda w: w.market(act.marketplace_sales),
    "marketplace_refunds": lambda w: w.market(act.marketplace_refunds),
    "web_sales": lambda w: w.web(act.web_sales),
    "web_refunds": lambda w: w.web(act.web_refunds),
    "online_union": Work.online,
    "transfers_out": lambda w: act.transfers_out(w.s.transfer_detail, w.s.items, SECOND_LOAD, w.fresh),
    "counts": Work.counted,
    "consolidate": Work.consolidated,
    "sync_inbound": lambda w: maintain.sync_inbound(durable(w.inbound_ledger()), w.derived(), SECOND_RUN),
    "append_inbound": Work.inbound_ledger,
    "append_activity": lambda w: maintain.append_activity(
        w.sales_ledger(), act.consolidate(w.sales(SECOND_LOAD), w.item_names()), SECOND_RUN
    ),
    "append_all_activity": lambda w: maintain.append_activity(w.sales_ledger(), durable(w.all_consolidated()), SECOND_RUN),
    "consolidate_sources": Work.all_consolidated,
    "merge_load": lambda w: w.merged[0].read().drop("bucket"),
    "refresh_adjustments": lambda w: _rounded(w.refreshed_adjustments()),
    "refresh_ages": Work.refreshed_ages,
    "sequence_ledger": Work.sequenced,
    "mark_segments": lambda w: w.ledger()[0],
    "set_adjustments": lambda w: _rounded(w.adjustments()),
    "rebuild_adjustments": lambda w: _rounded(w.rebuilt()["adjustments"]),
    "rebuild_ages": lambda w: w.rebuilt()["ages"],
    "inbound_lots": lambda w: ages.inbound_lots(*w.stored),
    "expand_lots": _traced(trace.expand_lots),
    "fifo_remaining": _remaining,
    "lots_on_hand": _on_hand,
    "ages": _ages,
    "ages_negative_lots": _ages_negative_lots,
    "lots_on_hand_negative_lots": lambda w: _shown_lots(*w.with_returned_lots),
    "trace_ages": _traced(trace.trace_ages),
    "trace_book": _traced(trace.trace_book),
    "age_report": _age_report,
    "rows_per_update_day": lambda w: diagnostics.rows_per_day(w.by_store(), "last_update"),
    "rows_per_activity_day": lambda w: diagnostics.rows_per_day(w.by_store(), "ts"),
    "item_footprint": lambda w: diagnostics.item_footprint(w.by_store()),
    "rank_footprint": lambda w: diagnostics.rank_footprint(durable(diagnostics.item_footprint(w.by_store())), AS_OF),
    "summary_update_day": lambda w: summaries.rows_per_day(w.summary_by_store(), "update_day"),
    "summary_activity_day": lambda w: summaries.rows_per_day(w.summary_by_store(), "day"),
    "summary_footprint": lambda w: summaries.item_footprint(w.summary_by_store()),
    "summary_ranks": lambda w: diagnostics.rank_footprint(durable(summaries.item_footprint(w.summary_by_store())), SECOND_RUN),
    "summary_load_lag": lambda w: summaries.load_lag(w.summary),
    "load_lag": lambda w: diagnostics.load_lag(w.dated()),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(build: Callable[[Work], DataFrame]):
        return lambda spark, folder: shown(build(Work(spark, folder)))

    return {name: bound(build) for name, build in BUILDERS.items()}
