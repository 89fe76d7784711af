"""What the physical plans must look like."""

import re
from datetime import datetime

import pytest

from shelfbook.config import Window
from shelfbook.operators import diagnostics, inbound, trace, windows
from shelfbook.operators.adjust import set_adjustments
from shelfbook.operators.ages import ages
from shelfbook.operators.sequence import Shape, order_runs
from shelfbook.plans.catalog import AS_OF, SECOND_LOAD, SECOND_RUN, Work

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def work(spark):
    return Work(spark, FOLDER)


def test_window_bounds_reach_the_scan(spark, work, tmp_path):
    work.s.sales_item.write.parquet(f"{tmp_path}/sales")
    window = Window(datetime(2010, 1, 1), datetime(2011, 1, 1))
    rows = windows.in_window(spark.read.parquet(f"{tmp_path}/sales"), "business_date", window, work.fresh)
    text = plan(rows.select("item_code", "quantity"))
    assert "GreaterThanOrEqual(business_date" in text and "LessThan(business_date" in text
    assert "register_price" not in text


def test_one_shuffle_orders_marks_and_adjusts(work):
    rows, shape = work.shaped
    adjusted = set_adjustments(work.ledger()[0], shape)
    assert plan(adjusted).count("Exchange hashpartitioning") == 1


def test_ages_pair_no_rows_with_lots(work):
    ledger, shape = work.stored
    text = plan(ages(ledger, set_adjustments(ledger, shape), shape))
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    assert len(re.findall(r"(?:SortMergeJoin|ShuffledHashJoin|BroadcastHashJoin)", text)) == 1


def test_long_catalogues_are_ranked_in_pieces(work):
    footprint = diagnostics.item_footprint(work.by_store())
    whole = diagnostics.rank_footprint(footprint, AS_OF)
    cut = diagnostics.rank_footprint(footprint, AS_OF, limit=20)
    assert sorted(map(tuple, cut.select(*whole.columns).collect())) == sorted(map(tuple, whole.collect()))


def test_shape_finds_long_runs(work):
    rows, shape = work.shaped
    assert shape.long_runs is None and not shape.negative_lots
    short = Shape.of(rows, limit=10)
    assert short.long_runs is not None and short.long_runs.groups > 0


def test_a_stored_ledger_is_not_shuffled_again(work):
    ledger, shape = work.stored
    adjustments = shape.store(set_adjustments(ledger, shape))
    chosen = shape.store(trace.closing_rows(ledger))
    for result in (set_adjustments(ledger, shape), ages(ledger, adjustments, shape), trace.trace_ages(ledger, adjustments, chosen, shape)):
        assert "Exchange hashpartitioning" not in plan(result)


def test_long_runs_are_stored_in_pieces_with_the_same_rows(work):
    rows, shape = work.shaped
    long = Shape.of(rows, limit=10)
    whole, cut = order_runs(rows, shape), order_runs(rows, long)
    assert "Bucketed: true" in plan(whole.groupBy("loc", "item").count()) and "Bucketed: true" not in plan(cut.groupBy("loc", "item").count())
    assert whole.select(*cut.columns).exceptAll(cut).isEmpty() and whole.count() == cut.count()


def test_inbound_tables_that_lie_by_shipment_are_not_shuffled_again(work):
    ships = work.by_shipment(work.ships(SECOND_LOAD, work.dealt), inbound.SHIPMENT)
    assert "Exchange hashpartitioning" not in plan(inbound.shipment_rollup(ships))
    plain = work.ships(SECOND_LOAD)
    assert ships.exceptAll(plain).isEmpty() and plain.exceptAll(ships).isEmpty()
    detail = work.by_shipment(work.applied())
    assert "Exchange hashpartitioning" not in plan(inbound.refresh_shipment_totals(detail, SECOND_RUN))
