"""Rows of a load that are read, shuffled and joined once."""

from __future__ import annotations

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_merge import CODES, DETAIL, ROWS, RUN2, activity, shipments, told, whole

from shelfbook.config import Window
from shelfbook.operators import inbound, maintain, merge, windows
from shelfbook.plans.catalog import SECOND_LOAD, Work
from shelfbook.session import tune


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def day(n):
    return datetime(2021, 1, n)


@pytest.mark.parametrize("by_line", [True, False])
def test_rows_that_meet_heads_are_read_once(spark, tmp_path, by_line):
    """The date is a column of the lines or of the heads; codes repeat among the new items and may be unknown."""
    lines = [("A", 1, day(2)), ("A", 2, day(5)), ("B", 1, day(2)), ("B", 2, day(5)), ("B", 3, day(9)), ("B", 4, day(2)), (None, 1, day(2)), (None, 2, day(5)), ("B", 5, None)]
    heads = [(1, day(2)), (2, day(5)), (3, day(9)), (2, day(5)), (5, None), (None, day(5))]
    table = spark.createDataFrame(lines, "code string, id int, ts timestamp_ntz")
    table = table if by_line else table.drop("ts")
    table.write.parquet(f"{tmp_path}/lines")
    head = spark.createDataFrame(heads, "id int, ts timestamp_ntz").withColumn("h", F.lit(1))
    head = head.drop("ts") if by_line else head
    fresh = spark.createDataFrame([("B",), ("B",), (None,)], "item_code string")
    for window, kept in (
        (Window(day(4), day(8)), [("A", 2), ("A", 2), ("B", 1), ("B", 2), ("B", 2), (None, 2), (None, 2)]),
        (Window(day(8), day(4)), [("B", 1)]),
        (Window(None, day(8)), [("B", 1), ("B", 2), ("B", 2)]),
    ):
        rows = windows.in_window(spark.read.parquet(f"{tmp_path}/lines"), "ts", window, fresh, "code", head, ["id"])
        assert plan(rows).count("/lines]") == 1
        assert sorted(((r.code, r.id) for r in rows.collect()), key=repr) == sorted(kept, key=repr)


def test_push_rows_are_dealt_by_transfer_once(spark):
    work = Work(spark, "/root/testdata/sf0.001")
    text = plan(work.push(SECOND_LOAD))
    assert len(re.findall(r"Exchange hashpartitioning\(transfer_id", text)) == 1
    assert "Exchange hashpartitioning(_source" not in text and "psh_qty#" not in "".join(re.findall(r"Exchange hashpartitioning.*", text))


def test_push_of_equal_rows_of_two_sources_counts_once(spark):
    detail = spark.createDataFrame([(1, "7", "3", 4, "a"), (1, "7", "3", 5, None), (2, "7", "3", None, "a")], "internal_shipment_num int, item string, ship_to string, total_qty bigint, order_type string")
    header = spark.createDataFrame([(1, day(5)), (2, day(5))], "internal_shipment_num int, actual_ship_ts timestamp_ntz")
    items = spark.createDataFrame([("7".zfill(20),)], "item_code string")
    types = spark.createDataFrame([("a", "Push")], "order_type string, order_category string")
    other = detail.filter("order_type = 'a'")
    push = inbound.warehouse_push([(detail, header), (detail, header), (other, header)], items, types, Window(day(4), day(8)), items.limit(0))
    assert sorted((r.transfer_id, r.loc, r.psh_qty, r.tot_qty) for r in push.filter("tot_qty > 0").collect()) == [
        ("0000000001", "00003", 4, 4), ("0000000001", "00003", 4, 9),
    ]
    assert [(r.transfer_id, r.psh_qty) for r in push.filter("tot_qty IS NULL").collect()] == [("0000000002", 0)]


def test_a_side_that_fits_a_task_is_hashed(spark):
    tune(spark)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(1000).selectExpr("CAST(id AS STRING) AS k", "id")
        met = rows.join(rows.selectExpr("k", "id AS other"), "k")
        assert "SortMergeJoin" in plan(met)
        met.collect()
        assert "ShuffledHashJoin" in plan(met).split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_news_reach_the_rows_of_a_run_without_the_whole_detail(spark, tmp_path, monkeypatch):
    """Repeated detail keys, unknown shipments and untouched runs as when every row of a touched run met the whole detail."""
    pick = random.Random(11)
    items = spark.createDataFrame(CODES, "item_code string, item string")
    sold = spark.createDataFrame(activity(pick, 200, 0, 500), ROWS)
    before = shipments(pick, 0, 40, 0, 500)
    first = maintain.append_inbound(sold, spark.createDataFrame(before, DETAIL), items, RUN2)
    unknown = first.filter("shpmt = 'tid000003' OR shpmt = 'tid000004'").withColumn("shpmt", F.lit(None).cast("string"))
    first = first.unionByName(unknown).localCheckpoint()
    news = [(*s[:4], s[4] + timedelta(hours=7), s[5], s[6]) for s in before[:6]]
    twice = [before[6], (*before[6][:4], before[6][4] + timedelta(hours=3), *before[6][5:])]  # one of them is no change
    detail = spark.createDataFrame(news + twice + before[8:20], DETAIL)
    ledger, _ = whole(spark, first, 4_000_000)
    store = merge.LedgerStore(spark, f"{tmp_path}/ledger", buckets=2)
    store.write(ledger)

    corrected = merge.corrected_rows(first, detail).select("loc", "item").distinct()
    touched = first.join(corrected, ["loc", "item"], "left_semi")
    want = maintain.sync_inbound(touched, detail, RUN2).unionByName(first.join(corrected, ["loc", "item"], "left_anti").select(*touched.columns))
    want, _ = whole(spark, want.localCheckpoint(), 4_000_000)
    monkeypatch.setattr(maintain, "sync_inbound", None)
    merge.merge_load(store, detail, sold.limit(0), items, RUN2)
    assert told(store.read().drop("bucket", "last_update")) == told(want.drop("last_update"))
