import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from helpers import LEDGER, ledger_rows, plain_ages

from shelfbook.operators.adjust import adjustment_rows, set_adjustments
from shelfbook.operators.ages import VARIANTS, age_name, ages, inbound_lots
from shelfbook.operators.sequence import Shape, mark_segments, sequence_ledger


def build(spark, rows, limit=None):
    raw = spark.createDataFrame(rows, LEDGER)
    shape = Shape.of(raw, **({"limit": limit} if limit else {}))
    ledger = mark_segments(sequence_ledger(raw, shape), shape)
    return ledger, shape


GOLDEN = [(0, "in", 10, None), (240, "out", -4, None), (480, "in", 5, None), (720, "set", None, 9), (960, "out", -6, None)]


@pytest.mark.parametrize("limit", [None, 2])
def test_golden_sequence_adjustments_and_ages(spark, limit):
    ledger, shape = build(spark, ledger_rows(GOLDEN), limit)
    seen = [tuple(r) for r in ledger.orderBy("u").select("u", "inv_q", "cr_set", "nx_in").collect()]
    assert seen == [(1, 10, 1, 3), (2, 6, 1, 3), (3, 11, 1, 4), (4, 11, 4, 5), (5, 5, 4, 5)]
    adj = set_adjustments(ledger, shape)
    got = [
        tuple(r)
        for r in adj.orderBy("cr_set", "nx_in")
        .select("cr_set", "nx_in", "adj_q", "min_inv_q", "min_a_inv_q", "n_adj_q", "f_adj_q", "f_cc", "span", "pct_adj", "f_pct_adj")
        .collect()
    ]
    zero, share = Decimal(0), Decimal("0.4")
    assert got == [
        (1, 3, 0, 6, 6, 0, 0, 0, 2, zero, zero),
        (1, 4, 0, 6, 6, 0, 0, 0, 3, zero, zero),
        (4, 5, -2, 5, 3, -2, -2, 0, 1, share, share),
    ]
    result = {r["u"]: r for r in ages(ledger, adj, shape).collect()}
    book = {u: [r[c] for c in ("inv_days", "a_inv_age", "m_inv_age", "qty_days", "qty_age")] for u, r in result.items()}
    assert book == {
        1: [0, None, None, 0, 0],
        2: [100, 10, 10, 40, 10],
        3: [120, 20, 20, 0, 0],
        4: [230, Decimal("20.909091"), 30, 0, None],
        5: [340, Decimal("30.909091"), 40, 240, 40],
    }
    counted = {u: [r[c] for c in ("aj_inv_days", "a_aj_inv_age", "m_aj_inv_age", "aj_qty_days", "aj_qty_age")] for u, r in result.items()}
    assert counted == {
        1: [0, None, None, 0, 0],
        2: [100, 10, 10, 40, 10],
        3: [120, 20, 20, 0, 0],
        4: [170, Decimal("18.888889"), 10, 0, None],
        5: [260, Decimal("28.888889"), 20, 200, Decimal("33.333333")],
    }
    for r in result.values():
        for measure in ("inv_days", "a_inv_age", "m_inv_age", "qty_days", "qty_age"):
            assert r[age_name(measure, "aj_")] == r[age_name(measure, "naj_")] == r[age_name(measure, "faj_")]


@pytest.mark.parametrize("limit", [None, 2])
def test_negative_zone(spark, limit):
    ledger, shape = build(spark, ledger_rows([(0, "in", 2, None), (1, "out", -3, None), (2, "in", 1, None), (3, "out", -4, None)]), limit)
    rows = adjustment_rows(ledger, shape).orderBy("u").select("inv_q", "nx_in", "n_adj_q", "f_adj_q", "f_cc")
    assert [tuple(r) for r in rows.collect()] == [(2, 3, 0, 0, 1), (-1, 3, 1, 4, 2), (0, 4, 1, 4, 2), (-4, 4, 4, 4, 2)]
    adj = set_adjustments(ledger, shape).orderBy("nx_in").select("nx_in", "n_adj_q", "f_adj_q", "f_cc", "span", "pct_adj", "f_pct_adj")
    assert [tuple(r) for r in adj.collect()] == [(3, 1, 4, 2, 2, 0, 1), (4, 4, 4, 2, 3, 0, 1)]


def test_opening_count(spark):
    ledger, shape = build(spark, ledger_rows([(0, "set", None, 7), (1, "in", 3, None)]))
    assert [tuple(r) for r in ledger.orderBy("u").select("inv_q", "cr_set", "nx_in").collect()] == [(None, 1, 2), (3, 1, 2)]
    adj = set_adjustments(ledger, shape)
    assert [tuple(r) for r in adj.select("adj_q", "min_inv_q", "min_a_inv_q").collect()] == [(0, 3, 3)]
    assert [r["u"] for r in ages(ledger, adj, shape).collect()] == [2]


def random_runs(seed, runs, length, negative_lots=False):
    rng = random.Random(seed)
    rows = []
    for k in range(runs):
        entries, hour = [], 0
        for _ in range(rng.randint(1, length)):
            hour += rng.choice([0, 1, 5, 30])
            flow = rng.choice(["in", "in", "out", "out", "set"])
            qty = {"in": rng.choice([0, 1, 3, 8]), "out": -rng.choice([0, 1, 2, 5, 9]), "set": None}[flow]
            if negative_lots and flow == "in" and rng.random() < 0.25:
                qty = -rng.randint(1, 4)
            entries.append((hour, flow, qty, rng.randint(0, 12) if flow == "set" else None))
        rows += ledger_rows(entries, item=f"I{k:03d}")
    return rows


def check_against_pairs(spark, rows, limit=None):
    ledger, shape = build(spark, rows, limit)
    ledger = ledger.cache()
    adj = set_adjustments(ledger, shape).cache()
    by_run = {}
    for r in ledger.orderBy("u").collect():
        by_run.setdefault((r["loc"], r["item"]), []).append(r.asDict())
    adjustments = {(a["loc"], a["item_code"], a["item"], a["cr_set"], a["nx_in"]): a.asDict() for a in adj.collect()}
    expected = {}
    for run in by_run.values():
        expected |= plain_ages(run, adjustments)
    got = {(r["loc"], r["item"], r["u"]): r for r in ages(ledger, adj, shape).collect()}
    assert got.keys() == expected.keys()
    for key, variants in expected.items():
        for prefix, values in variants.items():
            for measure, value in values.items():
                assert got[key][age_name(measure, prefix)] == value, (key, prefix, measure)


@pytest.mark.parametrize("limit", [None, 7])
def test_ages_equal_pairwise_rules(spark, limit):
    check_against_pairs(spark, random_runs(1, 40, 40), limit)


@pytest.mark.parametrize("limit", [None, 7])
def test_negative_lots_equal_pairwise_rules(spark, limit, monkeypatch):
    from shelfbook.operators import uneven

    monkeypatch.setattr(uneven, "BLOCK_LOTS", 3)
    check_against_pairs(spark, random_runs(2, 25, 40, negative_lots=True), limit)


@pytest.mark.parametrize("limit", [None, 7])
def test_trace_holds_the_lots_of_the_chosen_rows(spark, limit):
    from shelfbook.operators.trace import closing_rows, trace_ages, trace_book

    ledger, shape = build(spark, random_runs(3, 8, 30), limit)
    adj = set_adjustments(ledger, shape)
    chosen = closing_rows(ledger)
    lots = inbound_lots(ledger, shape).count()
    traced = trace_ages(ledger, adj, chosen, shape).collect()
    assert len(traced) == lots
    for r in traced:
        assert r["septa"] == 0 or r["ru_septa"] >= 0
    held = {}
    for r in traced:
        key = (r["loc"], r["item"], r["u"])
        held.setdefault(key, [Decimal(0), r["inv_days"]])[0] += r["in_age"] * r["septa"]
    assert all(total == days for total, days in held.values())
    assert trace_book(ledger, adj, chosen, shape).count() == lots


@pytest.mark.parametrize("second", [3, -1])
def test_large_quantities_and_long_ages(spark, second):
    years = 262_980  # hours in thirty years
    entries = [(0, "in", 20_000_000_000, None), (24, "in", second, None), (years, "out", -4, None), (years + 24, "out", -7, None)]
    check_against_pairs(spark, ledger_rows(entries))
