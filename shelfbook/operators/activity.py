"""Sales, returns, transfers and counts in one ledger shape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfbook.config import TRANSFER_CODES, Window
from shelfbook.functions.text import sku_extension
from shelfbook.operators.lookup import lookup_join
from shelfbook.operators.windows import in_window

MONEY = "decimal(19,4)"
ACTIVITY_SCHEMA = {
    "loc": "string", "item_code": "string", "sku_ext": "string", "shpmt": "string", "ts": "timestamp_ntz",
    "xacn": "string", "flow": "string", "qty": "bigint", "inv": "bigint", "psh_qty": "bigint",
    "md_qty": "bigint", "sld_val": MONEY, "md_sld_val": MONEY, "sld_fee": MONEY,
}
LEDGER_KEY = ("loc", "item_code", "ts", "sku_ext", "shpmt", "xacn")


def _activity(rows: DataFrame, **columns) -> DataFrame:
    """Ledger columns from the given ones; the rest is unknown."""
    def value(name: str) -> Column:
        given = columns.get(name)
        if isinstance(given, Column):
            return given
        return F.lit(given)

    return rows.select(*[value(name).cast(kind).alias(name) for name, kind in ACTIVITY_SCHEMA.items()])


def _at_stores(rows: DataFrame, stores: DataFrame | None) -> DataFrame:
    """Keep rows of active stores, where the population asks for that."""
    if stores is None:
        return rows
    return lookup_join(rows, stores.select(F.col("location_no").alias("loc")).distinct(), ["loc"], "left_semi")


def _followed(rows: DataFrame, items: DataFrame) -> DataFrame:
    return lookup_join(rows, items.select("item_code"), ["item_code"], "left_semi")


def store_sales(
    sales: DataFrame,
    headers: DataFrame,
    locations: DataFrame,
    items: DataFrame,
    window: Window,
    fresh: DataFrame,
    stores: DataFrame | None = None,
) -> DataFrame:
    """Store sales and returns.

    Without a store filter a location listed twice counts its sales twice, as in the source.
    """
    key = ["location_id", "xaction_type", "sales_xaction_id", "business_date"]
    sold = _followed(sales.filter(F.col("status") == "A"), items)
    rows = in_window(sold, "business_date", window, fresh, heads=headers.select(*key, "end_date"), on=key)
    places = locations if stores is None else stores.select("location_id", "location_no").distinct()
    rows = lookup_join(rows, places.select("location_id", F.col("location_no").alias("loc")), ["location_id"])
    returned = F.coalesce(F.col("is_return") == "Y", F.lit(False))
    marked_down = F.coalesce(F.col("register_price") < F.col("unit_price"), F.lit(False))
    sign = F.when(returned, 1).otherwise(-1)
    return _activity(
        rows,
        loc=F.col("loc"),
        item_code=F.col("item_code"),
        sku_ext=sku_extension(F.col("sku_ext")),
        ts=F.col("end_date"),
        xacn=F.when(returned, "Rtrn").otherwise("Sale"),
        flow=F.when(returned, "in").otherwise("out"),
        qty=sign * F.col("quantity"),
        md_qty=sign * F.when(marked_down, F.col("quantity")).otherwise(0),
        sld_val=F.col("extended_amt"),
        md_sld_val=F.when(marked_down, F.col("extended_amt")).otherwise(0),
    )


def _refund_split(refund: str, price: str) -> tuple[Column, Column]:
    """Refund taken from the value first, the remainder from the fee; both negative."""
    value = F.when(F.col(refund) >= F.col(price), F.col(price)).otherwise(F.col(refund))
    over = F.when(F.col(refund) > F.col(price), F.col(refund) - F.col(price)).otherwise(F.lit(0).cast(MONEY))
    return -value, -over


def _market_rows(orders, facilities, fulfil_header, fulfil_detail, items, prices, ts, window, fresh, stores):
    """Marketplace orders with fulfilment location where there is one, and the item's list price."""
    orders = orders.filter(
        F.col("order_status").isin("New", "Pending", "Shipped") & F.col("sku").startswith("D")
    ).withColumn("item_code", F.right(F.col("sku"), F.lit(20)))
    rows = _followed(in_window(orders, ts, window, fresh), items)
    rows = lookup_join(rows, facilities.withColumnRenamed("location_no", "facility_loc"), ["facility_id"])
    ours = fulfil_header.filter(F.col("order_system") == "MON").select(
        F.col("market_order_id").alias("order_id"), F.col("order_id").alias("fulfil_id")
    )
    good = fulfil_detail.filter(
        F.col("status").isin(1, 4) & (F.col("problem_status_id").isNull() | (F.col("problem_status_id") == 0))
    ).select(F.col("order_id").alias("fulfil_id"), F.col("location_no").alias("fulfil_loc"), "sku_ext")
    rows = rows.join(ours, "order_id", "left").join(good, "fulfil_id", "left")
    rows = rows.withColumn("loc", F.coalesce("fulfil_loc", "facility_loc"))
    return lookup_join(_at_stores(rows, stores), prices, ["item_code"])


def list_prices(product_master: DataFrame) -> DataFrame:
    return product_master.select("item_code", F.col("price").alias("list_price"))


def marketplace_sales(
    orders: DataFrame,
    facilities: DataFrame,
    fulfil_header: DataFrame,
    fulfil_detail: DataFrame,
    items: DataFrame,
    product_master: DataFrame,
    window: Window,
    fresh: DataFrame,
    stores: DataFrame | None = None,
) -> DataFrame:
    """The value is the price, not the price times the quantity."""
    rows = _market_rows(
        orders.filter(F.col("shipped_qty") > 0), facilities, fulfil_header, fulfil_detail, items,
        list_prices(product_master), "order_date", window, fresh, stores,
    )
    marked_down = F.coalesce(F.col("price") < F.col("list_price"), F.lit(False))
    return _activity(
        rows,
        loc=F.col("loc"),
        item_code=F.col("item_code"),
        sku_ext=sku_extension(F.col("sku_ext")),
        ts=F.col("order_date"),
        xacn="iSale",
        flow="out",
        qty=-F.col("shipped_qty"),
        md_qty=-F.when(marked_down, F.col("shipped_qty")).otherwise(0),
        sld_val=F.col("price"),
        md_sld_val=F.when(marked_down, F.col("price")).otherwise(0),
        sld_fee=F.col("shipping_fee"),
    )


def marketplace_refunds(
    orders: DataFrame,
    facilities: DataFrame,
    fulfil_header: DataFrame,
    fulfil_detail: DataFrame,
    items: DataFrame,
    product_master: DataFrame,
    window: Window,
    fresh: DataFrame,
    stores: DataFrame | None = None,
) -> DataFrame:
    rows = _market_rows(
        orders.filter(F.col("refund_amount") > 0), facilities, fulfil_header, fulfil_detail, items,
        list_prices(product_master), "refund_date", window, fresh, stores,
    )
    value, fee = _refund_split("refund_amount", "price")
    marked_down = F.coalesce(F.col("price") < F.col("list_price"), F.lit(False))
    return _activity(
        rows,
        loc=F.col("loc"),
        item_code=F.col("item_code"),
        sku_ext=sku_extension(F.col("sku_ext")),
        ts=F.col("refund_date"),
        xacn="iRtrn",
        flow="in",
        qty=0,
        md_qty=0,
        sld_val=value,
        md_sld_val=F.when(marked_down, value).otherwise(0),
        sld_fee=fee,
    )


def _web_rows(orders, facilities, items, prices, ts, window, fresh, stores):
    orders = orders.filter(
        (F.col("order_status") != "canceled")
        & (F.col("item_status") != "canceled")
        & F.col("sku").startswith("D")
        & (F.col("quantity") > 0)
    ).withColumn("item_code", F.right(F.col("sku"), F.lit(20)))
    rows = _followed(in_window(orders, ts, window, fresh), items)
    rows = lookup_join(rows, facilities.withColumnRenamed("location_no", "loc"), ["facility_id"])
    return lookup_join(_at_stores(rows, stores), prices, ["item_code"])


def web_sales(
    orders: DataFrame,
    facilities: DataFrame,
    items: DataFrame,
    product_master: DataFrame,
    window: Window,
    fresh: DataFrame,
    stores: DataFrame | None = None,
) -> DataFrame:
    rows = _web_rows(orders, facilities, items, list_prices(product_master), "order_date", window, fresh, stores)
    marked_down = F.coalesce(F.col("item_price") < F.col("list_price"), F.lit(False))
    return _activity(
        rows,
        loc=F.col("loc"),
        item_code=F.col("item_code"),
        sku_ext="0",
        ts=F.col("order_date"),
        xacn="hSale",
        flow="out",
        qty=-F.col("quantity"),
        md_qty=-F.when(marked_down, F.col("quantity")).otherwise(0),
        sld_val=F.col("extended_amount"),
        md_sld_val=F.when(marked_down, F.col("extended_amount")).otherwise(0),
        sld_fee=F.col("shipping_amount"),
    )


def web_refunds(
    orders: DataFrame,
    facilities: DataFrame,
    items: DataFrame,
    product_master: DataFrame,
    window: Window,
    fresh: DataFrame,
    stores: DataFrame | None = None,
) -> DataFrame:
    rows = _web_rows(
        orders.filter(F.col("item_refund_amount") > 0), facilities, items, list_prices(product_master),
        "last_modified", window, fresh, stores,
    )
    value, fee = _refund_split("item_refund_amount", "item_price")
    marked_down = F.coalesce(F.col("item_price") < F.col("list_price"), F.lit(False))
    return _activity(
        rows,
        loc=F.col("loc"),
        item_code=F.col("item_code"),
        sku_ext="0",
        ts=F.col("last_modified"),
        xacn="hRtrn",
        flow="in",
        qty=0,
        md_qty=0,
        sld_val=value,
        md_sld_val=F.when(marked_down, value).otherwise(0),
        sld_fee=fee,
    )


def transfers_out(
    transfers: DataFrame,
    items: DataFrame,
    window: Window,
    fresh: DataFrame,
    stores: DataFrame | None = None,
) -> DataFrame:
    """Completed outbound transfers by type of transfer."""
    rows = transfers.filter(
        (F.col("status_code") == 3) & F.col("transfer_type").isin(*TRANSFER_CODES) & (F.col("item_status") == 1)
    )
    rows = in_window(rows, "last_update", window, fresh).withColumnRenamed("from_loc", "loc")
    rows = _followed(_at_stores(rows, stores), items)
    code = reduce(
        lambda chain, pair: chain.when(F.col("transfer_type") == pair[0], pair[1]),
        TRANSFER_CODES.items(),
        F.when(F.lit(False), ""),
    )
    return _activity(
        rows,
        loc=F.col("loc"),
        item_code=F.col("item_code"),
        sku_ext="0",
        shpmt="na",
        ts=F.col("last_update"),
        xacn=code,
        flow="out",
        qty=-F.col("quantity"),
    )


def counts(
    adjustments: DataFrame,
    xacn: str,
    items: DataFrame,
    window: Window,
    fresh: DataFrame,
    stores: DataFrame | None = None,
) -> DataFrame:
    """Stock counts, by the stores (SICC) or by the centre (CICC)."""
    rows = in_window(adjustments.filter(F.col("new_qty").isNotNull()), "trans_date", window, fresh)
    rows = _followed(_at_stores(rows, stores), items)
    return _activity(
        rows,
        loc=F.col("loc"),
        item_code=F.col("item_code"),
        sku_ext="0",
        shpmt="na",
        ts=F.col("trans_date"),
        xacn=xacn,
        flow="set",
        inv=F.col("new_qty"),
    )


def online_union(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def consolidate(activity: DataFrame, items: DataFrame) -> DataFrame:
    """One row per ledger key and flow; counts at the same moment are summed."""
    rows = lookup_join(activity, items.select("item_code", "item"), ["item_code"])
    measures = {
        "qty": "bigint", "inv": "bigint", "psh_qty": "bigint", "md_qty": "bigint",
        "sld_val": MONEY, "md_sld_val": MONEY, "sld_fee": MONEY,
    }
    return (
        rows.withColumn("shpmt", F.coalesce("shpmt", F.lit("na")))
        .groupBy(*LEDGER_KEY, "flow", "item")
        .agg(*[F.sum(m).cast(t).alias(m) for m, t in measures.items()], F.count(F.lit(1)).alias("n"))
    )
