"""Hand-worked cases of the business rules."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfbook.config import GENERAL, OVERRIDES, ExcludeRule, Window, fixed_window
from shelfbook.functions.clock import epoch_hours, round_to_minute, years_between
from shelfbook.functions.text import alias_key, sku_extension, trimmed, zero_pad
from shelfbook.operators import activity, inbound, items, windows
from shelfbook.operators.lookup import lookup_join


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_text_and_time_helpers(spark):
    assert one(spark, alias_key(F.lit("830395033525"))) == "00000000830395033525"
    assert one(spark, alias_key(F.lit("12345"))) == "000000000012345"
    assert one(spark, zero_pad(F.lit("123456"), 5)) == "23456"
    for value, result in ((None, "0"), ("", "0"), (" ", "0"), ("7", "7")):
        assert one(spark, sku_extension(F.lit(value).cast("string"))) == result
    hours = epoch_hours(ntz("2020-01-01 01:01:00")) - epoch_hours(ntz("2020-01-01 00:59:00"))
    assert one(spark, hours) == 1
    assert one(spark, years_between(ntz("2023-12-31"), ntz("2024-01-01"))) == 1
    assert one(spark, round_to_minute(ntz("2020-01-01 00:00:29.998"))) == datetime(2020, 1, 1)
    assert one(spark, round_to_minute(ntz("2020-01-01 00:59:29.999"))) == datetime(2020, 1, 1, 1)
    assert trimmed(spark.createDataFrame([("CHA ", 1)], "a string, b int")).first()["a"] == "CHA"


def test_windows(spark):
    assert fixed_window("two_days", datetime(2021, 3, 3, 9)) == Window(datetime(2021, 3, 1), datetime(2021, 3, 3))
    assert fixed_window("last_week", datetime(2021, 3, 3)) == Window(datetime(2021, 2, 21), datetime(2021, 2, 28))
    assert fixed_window("last_week", datetime(2021, 2, 28)) == Window(datetime(2021, 2, 21), datetime(2021, 2, 28))
    ledger = spark.createDataFrame([(datetime(2021, 3, 1, 7),)], "last_update timestamp_ntz")
    assert windows.load_window("since_last_update", datetime(2021, 3, 9), ledger) == Window(
        datetime(2021, 2, 27), datetime(2021, 3, 9)
    )
    empty = windows.load_window("since_last_update", datetime(2021, 3, 9), ledger.limit(0))
    assert empty == Window(None, datetime(2021, 3, 9))
    rows = spark.createDataFrame(
        [("A", datetime(2021, 1, 1)), ("B", datetime(2021, 1, 1)), ("A", datetime(2021, 3, 1)), ("B", datetime(2021, 3, 9))],
        "item_code string, ts timestamp_ntz",
    )
    fresh = spark.createDataFrame([("B",)], "item_code string")
    window = Window(datetime(2021, 2, 1), datetime(2021, 3, 9))
    kept = windows.in_window(rows, "ts", window, fresh).collect()
    assert sorted((r[0], r[1].month) for r in kept) == [("A", 3), ("B", 1)]
    assert [r[0] for r in windows.in_window(rows, "ts", empty, fresh).collect()] == ["B"]


def test_unknown_vendor_is_not_excluded(spark):
    pm = spark.createDataFrame(
        [("a", None, "V", "HPBP", ""), ("b", "V", "V", "HPBP", ""), ("c", "TEXASBKNON", "V", "HPBP", ""),
         ("d", "V", "IDPOLLOCKP", "X", "SUP"), ("e", "V", "V", "X", ""), ("f", "V", "V", "X", "SUP")],
        "item_code string, purchase_from_vendor_id string, vendor_id string, product_type string, user_char15 string",
    )
    base = spark.createDataFrame([("e",), ("e",)], "item_code string")
    found = items.excluded_items(pm, base, ExcludeRule()).collect()
    assert sorted(r[0] for r in found) == ["b", "e", "f"]


def test_item_links(spark):
    pm = spark.createDataFrame([(c,) for c in "ABCD"], "item_code string")
    pmd = spark.createDataFrame(
        [("A", "B"), ("B", ""), ("C", "B"), ("D", "A")], "item_code string, report_item_code string"
    )
    base = spark.createDataFrame([("A",)], "item_code string")
    nothing = base.limit(0)
    pairs = lambda df: sorted(tuple(r) for r in df.collect())
    seeds = items.seed_links(pm, pmd, base, nothing)
    assert pairs(seeds) == [("A", "B"), ("D", "A")]
    links = items.expand_links(seeds, pm, pmd)
    assert pairs(links) == [("A", "B"), ("B", "B"), ("C", "B"), ("D", "A")]
    assert pairs(items.repair_parent(links)) == [("A", "B"), ("B", "B"), ("C", "B"), ("D", "B")]


def test_overrides_fold_in_order(spark):
    table = {r[0]: tuple(r)[1:] for r in items.override_table(spark, OVERRIDES).collect()}
    assert len(table) == 12
    assert table["00000000814229022213"] == (None, "00000000000010199979")
    assert table["00000000000000202626"] == ("00000000000000178790", None)
    assert table["00000000830395033501"] == ("00000000000001404029",) * 2
    later = items.override_table(spark, [(("x",), "1", "2"), (("x",), "3", None)])
    assert [tuple(r) for r in later.collect()] == [("x", "3", "2")]


def test_changed_items(spark):
    fields = "item string, rpt_it string, ri_vendor_id string, ri_section string, ic_cost decimal(19,4), ri_isbn string, ri_upc string"
    row = lambda code, vendor, cost: (code, "i", "r", vendor, "s", Decimal(cost), "n", None)
    old = spark.createDataFrame([(*row("a", "v", 1), datetime(2020, 1, 1)), (*row("b", None, 1), datetime(2020, 1, 1))],
                                f"item_code string, {fields}, last_update timestamp_ntz")
    new = spark.createDataFrame([row("a", "v", 2), row("b", "w", 1), row("c", "v", 1)], f"item_code string, {fields}")
    run = datetime(2021, 1, 1)
    result = {r["item_code"]: r for r in items.upsert_items(old, new, run).collect()}
    assert (result["a"]["ic_cost"], result["a"]["last_update"]) == (2, run)
    assert (result["b"]["ri_vendor_id"], result["b"]["last_update"]) == (None, datetime(2020, 1, 1))
    assert result["c"]["last_update"] == run
    strict = {r["item_code"]: r for r in items.upsert_items(old, new, run, null_safe=True).collect()}
    assert strict["b"]["ri_vendor_id"] == "w"


@pytest.mark.parametrize("mode", ["insert", "update"])
def test_inbound_quantities(spark, mode):
    cases = [
        (10, 8, 8, 10, 8, 8), (10, None, None, 4, 10, 4), (10, None, 8, 4, 0, 0), (None, 6, 6, 0, 6, 0),
        (10, None, 0, 4, 10, 4), (10, 0, 0, 4, 0, 0),
    ]
    unknown = (None, None, None, None, *((0, 0) if mode == "insert" else (None, None)))
    rows = [(i, *c[:4], None, True) for i, c in enumerate([*cases, unknown])]
    df = spark.createDataFrame(
        rows, "id int, ship_qty bigint, rcv_qty bigint, sum_rcv_q bigint, psh_qty bigint, qty bigint, touched boolean"
    )
    dates = {c: ntz(None) for c in ("rcv_date", "ru_rcv_dt", "ts")}
    df = df.withColumns({**dates, "shp_tns_dt": ntz("2020-01-03"), "ship_date": ntz("2020-01-01")})
    got = {r["id"]: r for r in inbound.derive_inbound(df, mode).collect()}
    assert [(got[i]["qty"], got[i]["psh_qty"]) for i in range(7)] == [c[4:] for c in [*cases, unknown]]
    assert got[0]["ts"] == datetime(2020, 1, 3)


CODE, OTHER = "00000000000000000001", "00000000000000000002"


def test_shipments_and_receipts(spark):
    day = datetime(2010, 7, 1)
    window = Window(datetime(2000, 1, 1), datetime(2020, 1, 1))
    item_rows = spark.createDataFrame([(CODE, CODE, "VENDOR")], "item_code string, item string, ri_vendor_id string")
    fresh = item_rows.select("item_code").limit(0)
    header = spark.createDataFrame(
        [("t1", "00001", "00944", day, 0), ("t2", "00001", "00944", day, 1), ("t3", "00002", "00944", day, 1),
         ("t4", "00001", "00012", day, 0)],
        "transfer_id string, to_loc string, from_loc string, date_received timestamp_ntz, drop_shipment int",
    )
    detail = spark.createDataFrame(
        [(f"t{i}", CODE, 123, 5) for i in (1, 2, 3, 4)] + [("t1", CODE, 123, 0)],
        "transfer_id string, item_code string, po_number int, qty int",
    )
    push = spark.createDataFrame([("t1", CODE, "00001", 3, 5)], "transfer_id string, item_code string, loc string, psh_qty bigint, tot_qty bigint")
    cutoffs = spark.createDataFrame(
        [("00001", datetime(2010, 1, 1)), ("00002", datetime(2011, 1, 1))], "loc string, min_pon timestamp_ntz"
    )
    ships = inbound.shipment_detail(detail, header, push, cutoffs, item_rows, window, fresh).collect()
    assert sorted((r["loc"], r["kind"] + r["ship_no"], r["xacn"], r["src"], r["psh_q"], r["ship_qty"]) for r in ships) == [
        ("00001", "pon0000000123", "Drps", "VENDOR", None, 5),
        ("00001", "tidt1", "CDC", "00944", 3, 5),
        ("00001", "tidt4", "StSi", "00012", None, 5),
        ("00002", "tidt3", "Drps", "VENDOR", None, 5),
    ]
    head = spark.createDataFrame(
        [(1, "00001", "s1", "W", day), (2, "00001", "s2", "R", day)],
        "batch_id bigint, loc string, shipment_no string, shipment_type string, process_start_ts timestamp_ntz",
    )
    lines = spark.createDataFrame([(1, CODE, 5, day), (2, CODE, 5, day)], "batch_id bigint, item_code string, qty int, process_ts timestamp_ntz")
    for historical, kind in ((False, "pon"), (True, "tid")):
        got = inbound.receipt_detail(head, lines, item_rows, window, fresh, historical).collect()
        assert sorted((r["ship_no"], r["kind"], r["xacn"], r["src"]) for r in got) == [
            ("s1", "tid", "RDC", "CDC"), ("s2", kind, "Drps", "VENDOR")
        ]


def test_order_types_and_refunds(spark):
    types = [("HPB Assortment",), ("TTB REORDER",), ("WEBORDER",), (None,)]
    got = inbound.order_categories(spark.createDataFrame(types, "order_type string"))
    assert {r[0]: r[1] for r in got.collect()} == {
        "HPB Assortment": "Push", "TTB REORDER": "Pull", "WEBORDER": "Whsl", None: "wtf",
    }
    window = Window(datetime(2020, 1, 1), datetime(2021, 1, 1))
    order = "facility_id string, sku string, order_date timestamp_ntz, last_modified timestamp_ntz, quantity int, " \
        "item_price decimal(19,4), item_refund_amount decimal(19,4), order_status string, item_status string"  # fmt: skip
    day = datetime(2020, 5, 1)
    orders = spark.createDataFrame(
        [("F", "D" + CODE, day, day, 1, Decimal(10), Decimal(12), "x", "x"), ("F", "D" + OTHER, day, day, 1, Decimal(10), Decimal(4), "x", "x")], order
    )
    places = spark.createDataFrame([("F", "00001")], "facility_id string, location_no string")
    catalogue = spark.createDataFrame([(CODE, Decimal(11)), (OTHER, Decimal(10))], "item_code string, price decimal(19,4)")
    codes = catalogue.select("item_code")
    got = activity.web_refunds(orders, places, codes, catalogue, window, codes.limit(0)).collect()
    assert {r["item_code"]: (r["sld_val"], r["md_sld_val"], r["sld_fee"]) for r in got} == {
        CODE: (-10, -10, -2), OTHER: (-4, 0, 0),
    }


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_lookups_are_plain_joins_without_hint_or_job(spark, how):
    rows = spark.range(300).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k")
    lookup = spark.range(0, 200).selectExpr("id AS k", "id * 2 AS v")
    plain = sorted(tuple(r) for r in rows.join(lookup, "k", how).collect())
    spark.sparkContext.setJobGroup(f"lookup-{how}", "planning")
    joined = lookup_join(rows, lookup, ["k"], how)
    text = joined._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in text
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(f"lookup-{how}")
    assert sorted(tuple(r) for r in joined.collect()) == plain


def test_populations():
    assert GENERAL.items.recent_days == 367 and len(GENERAL.items.either_vendors) == 28
    assert len(ExcludeRule().codes) == 19
