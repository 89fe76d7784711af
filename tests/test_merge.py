"""Loads merged into a stored ledger against the whole ledger written anew."""

from __future__ import annotations

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shelfbook.operators import diagnostics, maintain, merge, summaries
from shelfbook.operators.activity import ACTIVITY_SCHEMA
from shelfbook.operators.adjust import set_adjustments
from shelfbook.operators.ages import ages
from shelfbook.operators.sequence import Shape, mark_segments, sequence_ledger
from shelfbook.plans.catalog import Work

START = datetime(2020, 1, 1)
RUN1, RUN2 = datetime(2021, 1, 1), datetime(2021, 1, 3)
ROWS = ", ".join(f"{c} {t}" for c, t in ACTIVITY_SCHEMA.items()) + ", n bigint, last_update timestamp_ntz, item string"
DETAIL = "loc string, item_code string, shpmt string, xacn string, ts timestamp_ntz, qty bigint, psh_qty bigint"
CODES = [(f"{i:02d}", f"{i - i % 2:02d}") for i in range(12)]


def activity(pick, n, low, high):
    rows = {}
    for _ in range(n):
        code, item = pick.choice(CODES)
        flow, xacn = pick.choice([("out", "Sale"), ("out", "Mkt"), ("in", "Rtrn"), ("set", "SICC")])
        loc, ts = f"{pick.randrange(3):05d}", START + timedelta(hours=pick.randrange(low, high))
        qty, inv = (None, pick.randrange(30)) if flow == "set" else (pick.randrange(1, 6) * (1 if flow == "in" else -1), None)
        rows[loc, code, ts, xacn] = (loc, code, "0", "na", ts, xacn, flow, qty, inv, None, 0, None, None, None, 1, RUN1, item)
    return list(rows.values())


def shipments(pick, first, n, low, high):
    return [
        (f"{pick.randrange(3):05d}", pick.choice(CODES)[0], f"tid{i:06d}", "CDC", START + timedelta(hours=pick.randrange(low, high)), pick.choice([None, 5, 8, 20]), pick.randrange(9))
        for i in range(first, first + n)
    ]


def whole(spark, rows, limit):
    shape = Shape.of(rows, limit)
    return mark_segments(sequence_ledger(rows, shape), shape), shape


def told(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("seed, low, limit", [(1, 900, 4_000_000), (2, 0, 4_000_000), (3, 500, 7), (4, 995, 7)])
def test_two_loads_equal_one_ledger(spark, tmp_path, seed, low, limit):
    """``low`` is the first hour of the second load: late rows fall anywhere, or after all that is stored."""
    pick = random.Random(seed)
    items = spark.createDataFrame(CODES, "item_code string, item string")
    sold = spark.createDataFrame(activity(pick, 300, 0, 1000), ROWS)
    before = shipments(pick, 0, 60, 0, 1000)
    first = maintain.append_inbound(sold, spark.createDataFrame(before, DETAIL), items, RUN1)
    store = merge.LedgerStore(spark, f"{tmp_path}/ledger", buckets=8, per_file=9)
    ledger, shape = whole(spark, first, limit)
    store.write(ledger)
    adjustments = set_adjustments(ledger, shape)
    old_ages = ages(ledger, adjustments, shape)
    old_cells = summaries.cells(ledger).cache()

    # corrections of date and quantity in a few shipments, new shipments, and activity that overlaps the first load
    moved = [(*s[:4], s[4] + timedelta(hours=pick.randrange(-40, 40)), pick.choice([s[5], 11]), s[6]) if i % 15 == seed else s for i, s in enumerate(before)]
    moved = [s if s[4] >= START else (*s[:4], START, *s[5:]) for s in moved]
    detail = spark.createDataFrame(moved + shipments(pick, 100, 6, low, 1100), DETAIL)
    known = {(r.loc, r.item_code, r.ts, r.xacn) for r in sold.collect()}
    late = [r for r in activity(pick, 25, low, 1100) if (r[0], r[1], r[4], r[5]) not in known] + [tuple(r) for r in sold.limit(5).collect()]
    second = spark.createDataFrame(late, ROWS)

    want = maintain.append_activity(maintain.append_inbound(maintain.sync_inbound(first, detail, RUN2), detail, items, RUN2), second, RUN2)
    want, want_shape = whole(spark, want, limit)
    done = merge.merge_load(store, detail, second, items, RUN2, limit)
    got = store.read().drop("bucket")
    assert told(got) == told(want)

    new_cells = summaries.refresh_cells(store, done, old_cells).cache()
    assert told(new_cells) == told(summaries.cells(want))
    same = {"a": want}, {"a": new_cells}
    assert told(summaries.rows_per_day(same[1], "day")) == told(diagnostics.rows_per_day(same[0], "ts"))
    assert told(summaries.rows_per_day(same[1], "update_day")) == told(diagnostics.rows_per_day(same[0], "last_update"))
    assert told(summaries.item_footprint(same[1])) == told(diagnostics.item_footprint(same[0]))
    assert told(summaries.load_lag(new_cells)) == told(diagnostics.load_lag(want))

    new_adjustments = merge.refresh_adjustments(store, done, adjustments, limit)
    want_adjustments = set_adjustments(want, want_shape)
    assert told(new_adjustments) == told(want_adjustments)
    if seed == 1:  # compiling the age steps takes most of the time
        new_ages = merge.refresh_ages(store, done, new_adjustments, old_ages, limit)
        assert told(new_ages) == told(ages(want, want_adjustments, want_shape))


def names(folder):
    return {f"{d}/{x}" for d, _, files in os.walk(folder) for x in files if x.startswith("part-")}


def test_only_touched_buckets_are_written(spark, tmp_path):
    pick = random.Random(7)
    items = spark.createDataFrame(CODES, "item_code string, item string")
    store = merge.LedgerStore(spark, f"{tmp_path}/ledger", buckets=16)
    ledger, _ = whole(spark, spark.createDataFrame(activity(pick, 400, 0, 1000), ROWS), 4_000_000)
    store.write(ledger)
    before = names(store.folder)
    one = spark.createDataFrame([r for r in activity(pick, 40, 1000, 1100) if r[0] == "00001" and r[1] == "03"][:1] or activity(pick, 1, 1000, 1100), ROWS)
    detail = spark.createDataFrame([], DETAIL)
    done = merge.merge_load(store, detail, one, items, RUN2)
    after = names(store.folder)
    changed = {x.split("bucket=")[1].split("/")[0] for x in before ^ after}
    assert changed == {str(b) for b in done.buckets} and len(done.buckets) == 1
    assert before & after and store.read().count() == ledger.count() + 1
    # an appended row is numbered from the last inbound row of its run on, not from the start
    state = done.runs.first()
    assert state.from_u > 1 and state.from_u == got_last_in(ledger, one.first())
    # the same load again changes nothing
    again = merge.merge_load(store, detail, one, items, RUN2)
    assert again.buckets == [] and names(store.folder) == after


def got_last_in(ledger, row):
    same = (F.col("loc") == row["loc"]) & (F.col("item") == row["item"]) & (F.col("flow") == "in") & (F.col("ts") < F.lit(row["ts"]))
    return ledger.filter(same).agg(F.max("u")).first()[0]


def test_buckets_that_are_not_touched_are_not_read(spark, tmp_path):
    store = merge.LedgerStore(spark, f"{tmp_path}/ledger", buckets=4)
    ledger, _ = whole(spark, spark.createDataFrame(activity(random.Random(9), 200, 0, 500), ROWS), 4_000_000)
    store.write(ledger)
    text = store.read().filter(F.col("bucket").isin([1, 2]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in text and "bucket#" in text
    narrow = merge.corrected_rows(store.read(), spark.createDataFrame([], DETAIL))._jdf.queryExecution().executedPlan().toString()
    assert "md_sld_val" not in narrow and "inv_q" not in narrow


def test_a_long_run_lies_in_several_files(spark, tmp_path):
    rows = [("1", "A", "0", "na", START + timedelta(hours=h), "Sale", "out", -1, None, None, 0, None, None, None, 1, RUN1, "A") for h in range(100)]
    ledger, _ = whole(spark, spark.createDataFrame(rows, ROWS), 4_000_000)
    store = merge.LedgerStore(spark, f"{tmp_path}/ledger", buckets=4, per_file=10)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.write(ledger)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(names(store.folder)) > 1 and store.read().count() == 100


def test_the_second_load_brings_all_sources_and_rows_that_collapse(spark):
    work = Work(spark, "/root/testdata/sf0.01")
    rows = work.all_consolidated()
    groups = {r[0] for r in rows.select("xacn").distinct().collect()}
    assert {"Sale", "Rtrn", "iSale", "iRtrn", "hSale", "hRtrn", "SICC", "CICC", "Tsh", "StSo", "vRtn"} <= groups
    top = rows.agg(F.max("n"), *[F.count(c) for c in ("md_qty", "sld_val", "md_sld_val", "sld_fee")]).first()
    assert top[0] > 1 and all(top[1:])


def test_short_runs_of_a_load_are_staged_by_run(spark, tmp_path, monkeypatch):
    """Rows, touched runs, state and renumbered part are each a bucketed table; with runs that may be long, none is."""
    staged = []
    kept = Shape.store
    monkeypatch.setattr(Shape, "store", lambda shape, rows, sort=(): staged.append(kept(shape, rows, sort)) or staged[-1])
    pick = random.Random(9)
    items = spark.createDataFrame(CODES, "item_code string, item string")
    first = spark.createDataFrame(activity(pick, 200, 0, 500), ROWS)
    second = spark.createDataFrame(activity(pick, 30, 500, 600), ROWS)
    detail = spark.createDataFrame([], DETAIL)
    want, _ = whole(spark, maintain.append_activity(first, second, RUN2), 4_000_000)
    for limit, tables in ((4_000_000, 4), (7, 0)):
        store = merge.LedgerStore(spark, f"{tmp_path}/ledger-{limit}", buckets=4)
        store.write(whole(spark, first, limit)[0])
        staged.clear()
        merge.merge_load(store, detail, second, items, RUN2, limit)
        assert len(staged) == tables
        assert told(store.read().drop("bucket")) == told(want)
