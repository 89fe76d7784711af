"""Rows with few lots are paired with them; the others ask for positions or meet blocks of lots. Both give the same ages."""

import pytest

from shelfbook.operators import adjust, ages, sequence
from tests.helpers import LEDGER, ledger_rows

PLAIN = [(0, "in", 5, None), (5, "out", -2, None), (30, "in", 3, None), (31, "set", None, 7), (60, "out", -4, None), (90, "out", -1, None)]
TURNED = [(0, "in", 6, None), (7, "in", -2, None), (20, "out", -1, None), (33, "in", 4, None), (50, "out", -3, None), (51, "in", None, None), (80, "out", -9, None)]
UNKNOWN = [(0, "in", None, None), (3, "out", -1, None), (9, "in", 0, None), (12, "out", -2, None)]


def aged(spark, monkeypatch, few):
    monkeypatch.setattr(ages, "FEW_LOTS", few)
    rows = [r for item, entries in (("A", PLAIN), ("B", TURNED), ("C", UNKNOWN)) for r in ledger_rows(entries, item=item)]
    ledger = spark.createDataFrame(rows, LEDGER)
    shape = sequence.Shape.of(ledger)
    ordered = sequence.order_runs(ledger, shape)
    return ages.ages(ordered, adjust.set_adjustments(ordered, shape), shape)


@pytest.mark.parametrize("few", [0, 1, 2])
def test_ages_do_not_depend_on_the_way(spark, monkeypatch, few):
    paired, other = aged(spark, monkeypatch, 64), aged(spark, monkeypatch, few)
    assert paired.schema == other.schema
    order = ["loc", "item", "u"]
    expected = paired.orderBy(*order).collect()
    assert len(expected) == len(PLAIN) + len(TURNED) + len(UNKNOWN)
    assert other.orderBy(*order).collect() == expected


def test_few_lots_need_no_steps_of_a_list(spark, monkeypatch):
    plan = aged(spark, monkeypatch, 64)._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "Generate" not in plan


def test_markers_and_ranks_are_read_in_one_order(spark):
    ledger = spark.createDataFrame(ledger_rows(PLAIN), LEDGER)
    shape = sequence.Shape.of(ledger)
    ordered = sequence.order_runs(ledger, shape)
    for rows in (sequence.mark_segments(ordered, shape), ages.inbound_lots(ordered, shape)):
        assert "DESC" not in rows._jdf.queryExecution().executedPlan().toString()


def test_next_places_across_pieces(spark):
    rows = ledger_rows(PLAIN + TURNED)
    ledger = spark.createDataFrame([(*r[:5], r[5], *r[6:]) for r in rows], LEDGER)
    whole, cut = sequence.Shape.of(ledger), sequence.Shape.of(ledger, 3)
    assert cut.long_runs and not whole.long_runs
    placed = sequence.sequence_ledger(ledger, whole)
    marked = [sequence.mark_segments(placed, s).select("u", "cr_set", "nx_in").orderBy("u").collect() for s in (whole, cut)]
    assert marked[0] == marked[1]
