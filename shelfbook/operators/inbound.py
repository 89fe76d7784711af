"""Shipments and receipts, matched into one inbound detail table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfbook.config import (
    CENTRE_OPENED,
    FIRST_UPC_CODE,
    PULL_TYPES,
    PUSH_TYPES,
    TRANSIT_KNOWN_AFTER,
    WAREHOUSE,
    WHOLESALE_TYPES,
)
from shelfbook.config import Window as LoadWindow
from shelfbook.functions.clock import moment, round_to_minute
from shelfbook.functions.text import zero_pad
from shelfbook.operators.lookup import lookup_join
from shelfbook.operators.windows import in_window

DETAIL_KEY = ("loc", "item_code", "shpmt")
LYING = ("loc", "shpmt", "item_code")  # the same, in the order of tables that lie by shipment
SHIPMENT = ("loc", "kind", "ship_no")
DETAIL_COLUMNS = (
    *DETAIL_KEY, "xacn", "ts", "qty", "psh_qty", "ship_date", "ship_qty", "ru_shp_dt", "sum_shp_q",
    "rcv_date", "rcv_qty", "ru_rcv_dt", "sum_rcv_q", "src", "shp_tns_dt", "last_update",
)


def by_shipment(rows: DataFrame, buckets: int | None) -> DataFrame:
    return rows.repartition(buckets, *SHIPMENT) if buckets else rows


def order_categories(*details: DataFrame) -> DataFrame:
    """Each order type once, classed by its first eight characters."""
    types = reduce(DataFrame.union, [d.select("order_type") for d in details]).distinct()
    start = F.left(F.col("order_type"), F.lit(8))
    category = (
        F.when(start.isin(*PUSH_TYPES), "Push")
        .when(start.isin(*PULL_TYPES), "Pull")
        .when(start.isin(*WHOLESALE_TYPES), "Whsl")
        .otherwise("wtf")
    )
    return types.select("order_type", category.alias("order_category"))


def warehouse_push(
    sources: Sequence[tuple[DataFrame, DataFrame]],
    items: DataFrame,
    categories: DataFrame,
    window: LoadWindow,
    fresh: DataFrame,
) -> DataFrame:
    """Push and total quantity per (transfer, code, location); equal rows of two sources count once.

    ``sources`` are (detail, header) pairs: the live tables and their archives.
    """
    codes = items.select("item_code")

    def one(source: int, detail: DataFrame, header: DataFrame) -> DataFrame:
        lines = lookup_join(detail.withColumn("item_code", zero_pad(F.col("item"), 20)), codes, ["item_code"])
        heads = header.select("internal_shipment_num", "actual_ship_ts")
        shipped = in_window(lines, "actual_ship_ts", window, fresh, heads=heads, on=["internal_shipment_num"])
        # A missing order type matches no category.
        typed = lookup_join(shipped, categories, ["order_type"], "left")
        pushed = F.when(F.col("order_category") == "Push", F.col("total_qty"))
        return typed.select(
            F.lit(source).alias("_source"),
            zero_pad(F.col("internal_shipment_num"), 10).alias("transfer_id"),
            "item_code",
            zero_pad(F.col("ship_to"), 5).alias("loc"),
            F.coalesce(pushed, F.lit(0)).alias("psh_qty"),
            "total_qty",
        )

    # Dealt by transfer, as the shipped lines are when they meet them, the rows are added up and compared without another shuffle.
    rows = reduce(DataFrame.unionByName, [one(i, d, h) for i, (d, h) in enumerate(sources)]).repartition("transfer_id")
    sums = rows.groupBy("_source", "transfer_id", "item_code", "loc").agg(
        F.sum("psh_qty").cast("bigint").alias("psh_qty"), F.sum("total_qty").cast("bigint").alias("tot_qty")
    )
    return sums.drop("_source").distinct()


def shipment_detail(
    detail: DataFrame,
    header: DataFrame,
    push: DataFrame,
    cutoffs: DataFrame,
    items: DataFrame,
    window: LoadWindow,
    fresh: DataFrame,
    stores: DataFrame | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Shipped quantity per (code, location, shipment), with its kind of key, origin and push quantity.

    With ``buckets`` the rows are dealt by shipment over so many, in place of the shuffle of the roll-up.
    """
    lines = detail.filter(F.col("qty") > 0)
    lines = in_window(lines, "date_received", window, fresh, heads=header, on=["transfer_id"])
    is_upc = F.col("item_code") >= FIRST_UPC_CODE
    # UPC codes are "shipped" from the warehouse only as a bookkeeping step.
    lines = lines.filter(~is_upc | (F.col("from_loc") != WAREHOUSE)).withColumnRenamed("to_loc", "loc")
    if stores is not None:
        lines = lookup_join(lines, stores.select(F.col("location_no").alias("loc")).distinct(), ["loc"])
    lines = lookup_join(lines, items.select("item_code", "ri_vendor_id"), ["item_code"])
    lines = lines.join(push.select("transfer_id", "item_code", "loc", "psh_qty"), ["transfer_id", "item_code", "loc"], "left")
    lines = lookup_join(lines, cutoffs, ["loc"], "left")
    dropped, received = F.col("drop_shipment") == 1, F.col("date_received")
    by_order = dropped & (received >= F.coalesce(F.col("min_pon"), received))
    from_warehouse = F.col("from_loc") == WAREHOUSE
    shipped = lines.select(
        "item_code",
        "loc",
        F.when(by_order, zero_pad(F.col("po_number"), 10)).otherwise(F.col("transfer_id")).alias("ship_no"),
        F.when(by_order, "pon").otherwise("tid").alias("kind"),
        F.when(from_warehouse & (F.col("drop_shipment") == 0), "CDC")
        .when(from_warehouse & dropped, "Drps")
        .otherwise("StSi")
        .alias("xacn"),
        F.left(F.when(dropped, F.col("ri_vendor_id")).otherwise(F.col("from_loc")), F.lit(10)).alias("src"),
        F.col("psh_qty").alias("psh_q"),
        "date_received",
        "qty",
    )
    return by_shipment(shipped, buckets).groupBy("item_code", "loc", "ship_no", "kind", "xacn", "src", "psh_q").agg(
        F.min("date_received").alias("ship_date"), F.sum("qty").cast("bigint").alias("ship_qty")
    )


def shipment_rollup(ships: DataFrame) -> DataFrame:
    return ships.groupBy(*SHIPMENT).agg(
        F.min("ship_date").alias("ru_shp_dt"), F.sum("ship_qty").cast("bigint").alias("sum_shp_q")
    )


def receipt_detail(
    header: DataFrame,
    detail: DataFrame,
    items: DataFrame,
    window: LoadWindow,
    fresh: DataFrame,
    historical: bool = False,
    stores: DataFrame | None = None,
) -> DataFrame:
    """Received quantity per (code, location, shipment). Historical tables key every type as 'tid'."""
    lines = in_window(
        detail.filter(F.col("item_code") < FIRST_UPC_CODE), "process_ts", window, fresh, heads=header, on=["batch_id"]
    )
    if stores is not None:
        lines = lookup_join(lines, stores.select(F.col("location_no").alias("loc")).distinct(), ["loc"])
    lines = lookup_join(lines, items.select("item_code", "ri_vendor_id"), ["item_code"])
    type_, started, opened = F.col("shipment_type"), F.col("process_start_ts"), moment(CENTRE_OPENED)
    kind = F.lit("tid") if historical else F.when(type_ == "R", "pon").otherwise("tid")

    def centre(is_open: Column) -> Column:
        return F.when(is_open, "CDC").otherwise("RDC")

    # The code changes after the opening moment, the source at it; they differ at exactly that moment.
    return lines.groupBy(
        "item_code",
        "loc",
        F.col("shipment_no").alias("ship_no"),
        kind.alias("kind"),
        F.when(type_ == "W", centre(started > opened)).when(type_ == "R", "Drps").otherwise("StSi").alias("xacn"),
        F.left(
            F.when(type_ == "R", F.col("ri_vendor_id")).when(type_ == "W", centre(started >= opened)).otherwise(type_),
            F.lit(10),
        ).alias("src"),
    ).agg(
        F.min("process_start_ts").alias("rcv_date"),
        F.coalesce(F.sum("qty"), F.lit(0)).cast("bigint").alias("rcv_qty"),
    )


def combine_receipts(*receipts: DataFrame, buckets: int | None = None) -> DataFrame:
    return (
        by_shipment(reduce(DataFrame.unionByName, receipts), buckets)
        .groupBy("item_code", *SHIPMENT, "xacn", "src")
        .agg(F.min("rcv_date").alias("rcv_date"), F.sum("rcv_qty").cast("bigint").alias("rcv_qty"))
    )


def receipt_rollup(receipts: DataFrame) -> DataFrame:
    return receipts.groupBy(*SHIPMENT).agg(
        F.min("rcv_date").alias("ru_rcv_dt"), F.sum("rcv_qty").cast("bigint").alias("sum_rcv_q")
    )


def match_ship_receive(ships: DataFrame, receipts: DataFrame) -> DataFrame:
    """Full outer match on (code, location, shipment); the shipping side wins where both know."""
    key = [*SHIPMENT, "item_code"]  # in this order staged tables lie, and need no sort
    renamed = receipts.withColumnsRenamed({"xacn": "rcv_xacn", "src": "rcv_src"})
    return ships.join(renamed, key, "full_outer").select(
        "item_code",
        *SHIPMENT,
        F.coalesce("xacn", "rcv_xacn").alias("xacn"),
        F.coalesce("src", "rcv_src").alias("src"),
        "ship_date",
        "rcv_date",
        "ship_qty",
        F.coalesce(F.col("psh_q"), F.lit(0)).alias("psh_qty"),
        "rcv_qty",
    )


def stage_inbound(matched: DataFrame, ship_ru: DataFrame, rcv_ru: DataFrame, transit: DataFrame) -> DataFrame:
    """Adds the shipment-wide figures, the expected arrival and the number of rows per key (K6)."""
    rows = lookup_join(matched, ship_ru, SHIPMENT, "left")
    rows = lookup_join(rows, rcv_ru, SHIPMENT, "left")
    # From the distribution centre any vendor's transit time fits, so the vendor is left out of that key.
    any_vendor = F.col("xacn") == "CDC"
    times = transit.select(
        "loc", "xacn", F.when(any_vendor, "").otherwise(F.col("vndr")).alias("_vendor"), "mdn_transit_hrs"
    )
    first_seen = F.coalesce("ship_date", "ru_shp_dt", "rcv_date", "ru_rcv_dt")
    rows = rows.withColumn(
        "_vendor",
        F.when(first_seen > moment(TRANSIT_KNOWN_AFTER), F.when(any_vendor, "").otherwise(F.col("src"))),
    )
    rows = lookup_join(rows, times, ["loc", "xacn", "_vendor"], "left")
    shipped = F.coalesce("ship_date", "ru_shp_dt")
    same_key = Window.partitionBy(*SHIPMENT, "item_code")
    return rows.select(
        "loc",
        "item_code",
        F.concat("kind", "ship_no").alias("shpmt"),
        "xacn",
        "ship_date",
        "ship_qty",
        "psh_qty",
        "ru_shp_dt",
        "sum_shp_q",
        "rcv_date",
        "rcv_qty",
        "ru_rcv_dt",
        "sum_rcv_q",
        "src",
        F.timestamp_add("HOUR", F.col("mdn_transit_hrs"), shipped).alias("shp_tns_dt"),
        F.count(F.lit(1)).over(same_key).alias("dups"),
    )


def apply_receipts(detail: DataFrame, staged: DataFrame, run_ts: datetime) -> DataFrame:
    """Fill in receipts that were missing; ``touched`` marks the rows changed in this run."""
    fields = ("rcv_date", "rcv_qty", "ru_rcv_dt", "sum_rcv_q")
    known = staged.filter(F.col("rcv_date").isNotNull() | F.col("ru_rcv_dt").isNotNull()).select(
        *DETAIL_KEY, *[F.col(f).alias(f"new_{f}") for f in fields], F.lit(True).alias("found")
    )
    joined = detail.join(known, list(LYING), "left")
    fill = F.col("rcv_date").isNull() & F.col("found").isNotNull()
    changed = {f: F.when(fill, F.col(f"new_{f}")).otherwise(F.col(f)) for f in fields}
    changed["last_update"] = F.when(fill, moment(run_ts)).otherwise(F.col("last_update"))
    return joined.select(
        *[changed[c].alias(c) if c in changed else F.col(c) for c in detail.columns], fill.alias("touched")
    )


def refresh_shipment_totals(detail: DataFrame, run_ts: datetime) -> DataFrame:
    """Set the received totals of a shipment from all of its rows, on rows where they differ or are
    unknown."""
    key = ["loc", "shpmt"]
    totals = detail.groupBy(*key).agg(
        F.sum("rcv_qty").cast("bigint").alias("all_rcv_q"), F.max("ru_rcv_dt").alias("all_rcv_dt")
    )
    joined = lookup_join(detail, totals, key)
    date, quantity = F.col("ru_rcv_dt"), F.col("sum_rcv_q")
    stale = (
        date.isNull()
        | quantity.isNull()
        | F.coalesce(date != F.col("all_rcv_dt"), F.lit(False))
        | F.coalesce(quantity != F.col("all_rcv_q"), F.lit(False))
    )
    earlier = F.col("touched") if "touched" in detail.columns else F.lit(False)
    changed = {
        "ru_rcv_dt": F.when(stale, F.col("all_rcv_dt")).otherwise(date),
        "sum_rcv_q": F.when(stale, F.col("all_rcv_q")).otherwise(quantity),
        "last_update": F.when(stale, moment(run_ts)).otherwise(F.col("last_update")),
    }
    plain = [c for c in detail.columns if c != "touched"]
    return joined.select(
        *[changed[c].alias(c) if c in changed else F.col(c) for c in plain], (earlier | stale).alias("touched")
    )


def derived_columns(insert: bool) -> dict[str, Column]:
    """Date, quantity and push quantity of an inbound row.

    An update starts from the push quantity derived before, so that can only shrink; and it leaves
    unknown quantities unknown, where an insert makes them 0.
    """
    shipped, received, pushed = F.col("ship_qty"), F.col("rcv_qty"), F.col("psh_qty")
    total, zero = F.col("sum_rcv_q"), F.lit(0)
    not_delivered = (F.coalesce(total, zero) > 0) & received.isNull()
    not_received = total.isNull() & received.isNull()
    capped = F.when(received < pushed, received).otherwise(pushed)
    known = (lambda c: F.coalesce(c, zero)) if insert else (lambda c: c)
    return {
        "ts": F.coalesce("rcv_date", "ru_rcv_dt", "shp_tns_dt", "ship_date"),
        "qty": F.when(not_delivered, 0)
        .when(not_received, known(shipped))
        .otherwise(F.coalesce(received, shipped, zero)),
        "psh_qty": F.when(not_delivered, 0).when(not_received, known(pushed)).otherwise(known(capped)),
    }


def derive_inbound(detail: DataFrame, mode: str = "update") -> DataFrame:
    """Re-derive touched rows (update) or derive all rows (insert)."""
    derived = derived_columns(insert=mode == "insert")
    if mode == "insert":
        return detail.withColumns(derived)
    return detail.withColumns(
        {name: F.when(F.col("touched"), value).otherwise(F.col(name)) for name, value in derived.items()}
    )


def insert_inbound(detail: DataFrame, staged: DataFrame, run_ts: datetime) -> DataFrame:
    """Add staged rows whose key is new. Shipping dates are stored to the minute."""
    fresh = staged.join(detail.select(*DETAIL_KEY), list(LYING), "left_anti")
    stored = derive_inbound(fresh, "insert").withColumns(
        {
            **{c: round_to_minute(F.col(c)) for c in ("ship_date", "ru_shp_dt", "shp_tns_dt")},
            "last_update": moment(run_ts),
        }
    )
    return detail.select(*DETAIL_COLUMNS).unionByName(stored.select(*DETAIL_COLUMNS))
