"""Steps of a load that neither sort nor shuffle again what already lies in order."""

from __future__ import annotations

import pytest

from shelfbook.operators import maintain
from shelfbook.operators.sequence import LEDGER_ORDER, RUN, Shape, mark_segments, sequence_ledger
from shelfbook.session import durable_by, tune

ROWS = "loc string, item string, item_code string, ts int, sku_ext string, shpmt string, xacn string, flow string, qty int"


def ledger(spark):
    flows = [("Rtrn", "in"), ("Sale", "out"), ("SICC", "set")]
    rows = [(f"0000{i % 2}", f"{i % 3}", f"{i % 3}", i * 7 % 20, "0", "na", *flows[i % 7 % 3], i % 5) for i in range(60)]
    return spark.createDataFrame([*rows, (None, "1", "1", None, "0", "na", "Sale", "out", None)], ROWS)


def sorts(df):
    """Sorts in the plan of a DataFrame that was not run yet."""
    return df._jdf.queryExecution().executedPlan().toString().count(" Sort [")


def told(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_markers_follow_in_the_order_that_gave_the_places(spark):
    rows, shape = ledger(spark), Shape()
    again = mark_segments(sequence_ledger(rows, shape), shape)
    once = mark_segments(sequence_ledger(rows, shape), shape, LEDGER_ORDER)
    assert sorts(again) == 2 and sorts(once) == 1
    assert told(once) == told(again)


def test_a_bucket_in_one_file_is_not_sorted_again(spark):
    tune(spark)
    shape = Shape()
    marked = mark_segments(sequence_ledger(ledger(spark), shape), shape)
    stored = durable_by(marked.repartition(4, *RUN), RUN, 4, ["u"])
    over = mark_segments(stored, shape)
    assert sorts(over) == 0
    assert told(over.select(*marked.columns)) == told(marked)


def test_repeated_keys_are_found_within_runs_and_across_items(spark):
    row = ("00001", "a", "7", 1, "0", "na", "Sale", "out", 1)
    other = ("00001", "b", "7", 1, "0", "na", "Sale", "out", 2)  # the same key under another item
    alike = ("00001", "b", "8", 1, "0", "na", "Sale", "out", 2)
    empty = (None, None, None, None, None, None, None, None, None)

    def check(*rows):
        maintain.assert_unique_in_runs(spark.createDataFrame(rows, ROWS), RUN, maintain.LEDGER_KEY, "ledger")

    check(row, alike, empty)
    check(row, (*other[:3], 2, *other[4:]))
    for rows in ((row, row), (row, other), (empty, empty)):
        with pytest.raises(ValueError, match="repeated keys"):
            check(*rows)
