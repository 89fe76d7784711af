from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shelfbook.config import GENERAL, NEW_GOODS, VENDOR_GROUP, Window
from shelfbook.operators import inbound, maintain
from shelfbook.plans import pipeline
from shelfbook.sources.standins import Standins
from shelfbook.sources.tables import publish, publish_version, read_version

FOLDER = "/root/testdata/sf0.001"


def sources(spark):
    s = Standins(spark, FOLDER)
    tables = {
        "product_master": s.product_master, "product_master_dist": s.product_master_dist,
        "base_inventory": s.base_inventory, "shipment_header": s.shipment_header,
        "shipment_detail": s.shipment_detail, "dropship_cutoff": s.cutoffs, "transit_times": s.transit,
        "receive_header": s.receipts[0], "receive_detail": s.receipts[1],
        "receive_header_hist": s.receipts_hist[0], "receive_detail_hist": s.receipts_hist[1],
        "sales_item": s.sales_item, "sales_header": s.sales_header, "locations": s.locations,
        "market_order": s.market_order, "facility": s.facilities, "fulfil_header": s.fulfil_header,
        "fulfil_detail": s.fulfil_detail, "web_order": s.web_order, "transfer_detail": s.transfer_detail,
        "store_count": s.count_adjustment(False), "centre_count": s.count_adjustment(True),
    }
    for part, (detail, header) in zip(("", "_archive1", "_archive2"), s.warehouse):
        tables |= {f"wms_detail{part}": detail, f"wms_header{part}": header}
    return tables, s.items


def empty(spark, df, columns):
    return df.select(*columns).limit(0)


BUSINESS = (
    "loc", "item_code", "item", "sku_ext", "shpmt", "ts", "xacn", "flow", "qty", "inv", "psh_qty", "md_qty", "sld_val",
    "n", "u", "inv_q", "cr_set", "nx_in",
)


def rows(df, columns=BUSINESS):
    return sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))


def test_two_loads_give_what_one_load_gives(spark, tmp_path):
    tables, items = sources(spark)
    detail_schema = ", ".join(
        f"{c} " + ("timestamp_ntz" if c in ("ts", "ship_date", "ru_shp_dt", "rcv_date", "ru_rcv_dt", "shp_tns_dt", "last_update")
                   else "bigint" if "q" in c.split("_")[-1] else "string")
        for c in inbound.DETAIL_COLUMNS
    )
    no_detail = spark.createDataFrame([], detail_schema)
    no_ledger = spark.createDataFrame(
        [],
        "loc string, item_code string, sku_ext string, shpmt string, ts timestamp_ntz, xacn string, flow string, qty bigint, "
        "inv bigint, psh_qty bigint, md_qty bigint, sld_val decimal(19,4), md_sld_val decimal(19,4), sld_fee decimal(19,4), "
        "n bigint, last_update timestamp_ntz, item string",
    )
    assert tuple(no_ledger.columns) == maintain.LEDGER_COLUMNS
    end = datetime(2024, 2, 1)
    whole = pipeline.load_ledger(
        tables, GENERAL, items, no_detail, no_ledger, datetime(2024, 2, 1, 6), Window(datetime(2000, 1, 1), end)
    )
    # The second load cuts long runs in pieces; the first covers everything before its end.
    first = pipeline.load_ledger(
        tables, GENERAL, items, no_detail, no_ledger, datetime(2009, 1, 1, 6), Window(None, datetime(2009, 1, 1))
    )
    detail = publish(first.detail, str(tmp_path), "detail", "1")
    ledger = publish(first.ledger, str(tmp_path), "ledger", "1", "loc", "item", "u")
    second = pipeline.load_ledger(
        tables, GENERAL, items, detail, ledger, datetime(2024, 2, 1, 6), Window(datetime(2008, 12, 30), end), limit=40
    )
    assert second.shape.long_runs is not None
    assert rows(second.ledger) == rows(whole.ledger)

    stored = publish(second.ledger, str(tmp_path), "ledger", "2", "loc", "item", "u")
    adjustments, ages = pipeline.derived_figures(stored, GENERAL, second.shape)
    plain_adjustments, plain_ages = pipeline.derived_figures(whole.ledger, GENERAL)
    assert rows(adjustments, adjustments.columns) == rows(plain_adjustments, adjustments.columns)
    assert rows(ages, ages.columns) == rows(plain_ages, ages.columns)

    # The same window once more changes nothing but times of update.
    again = pipeline.load_ledger(
        tables, GENERAL, items, second.detail, stored, datetime(2024, 2, 1, 7), Window(datetime(2008, 12, 30), end)
    )
    assert rows(again.ledger) == rows(second.ledger)


def test_catalogue_of_each_population(spark):
    tables, _ = sources(spark)
    run = datetime(2001, 12, 31, 12)
    general = pipeline.item_catalogue(tables, GENERAL, run)
    new_goods = pipeline.item_catalogue(tables, NEW_GOODS, run)
    group = pipeline.item_catalogue(tables, VENDOR_GROUP, run, elsewhere=new_goods)
    assert 0 < new_goods.count() < general.count()
    assert group.count() > 0
    with pytest.raises(ValueError):
        pipeline.item_catalogue(tables, VENDOR_GROUP, run)
    again = pipeline.item_catalogue(tables, GENERAL, datetime(2002, 1, 1), current=general)
    assert rows(again, again.columns) == rows(general, general.columns)


def test_a_version_is_seen_whole_or_not_at_all(spark, tmp_path):
    folder = str(tmp_path)
    table = lambda n: spark.range(n).withColumn("qty", F.col("id") * 2)
    with pytest.raises(LookupError):
        read_version(spark, folder)
    publish_version({"adjustments": table(3), "ages": table(4)}, folder, "1")

    broken = table(9).withColumn("qty", F.when(F.col("id") == 8, F.raise_error(F.lit("lost"))).otherwise(F.col("qty")))
    with pytest.raises(Exception, match="lost"):
        publish_version({"adjustments": table(5), "ages": broken}, folder, "2")
    assert (tmp_path / "adjustments" / "version=2").exists()
    assert {name: df.count() for name, df in read_version(spark, folder).items()} == {"adjustments": 3, "ages": 4}
    with pytest.raises(LookupError):
        read_version(spark, folder, "2")

    publish_version({"adjustments": table(5), "ages": table(9)}, folder, "2")
    assert {name: df.count() for name, df in read_version(spark, folder).items()} == {"adjustments": 5, "ages": 9}
    assert read_version(spark, folder, "1")["ages"].count() == 4
    with pytest.raises(ValueError):
        publish_version({"ages": table(1)}, folder, "1")


def test_a_manifest_that_was_not_finished_names_nothing(spark, tmp_path):
    (tmp_path / "manifest" / "version=1" / "_temporary").mkdir(parents=True)
    (tmp_path / "manifest" / "version=1" / "_temporary" / "part-0.parquet").write_bytes(b"PAR1")
    with pytest.raises(LookupError):
        read_version(spark, str(tmp_path))
