"""Lots on hand of any row, against all lots of every row."""

import random

import pytest
from helpers import LEDGER, ledger_rows
from pyspark.sql import functions as F

from shelfbook.operators import trace
from shelfbook.operators.adjust import set_adjustments
from shelfbook.operators.sequence import Shape, mark_segments, sequence_ledger


def histories(seed, least, n=60):
    pick = random.Random(seed)
    rows = []
    for loc in ("00001", "00002", "00003"):
        entries = []
        for hour in sorted(pick.sample(range(1000), n)):
            flow = pick.choice(["in", "in", "out", "out", "out", "set"])
            qty = {"in": pick.randrange(least, 9), "out": -pick.randrange(1, 6), "set": None}[flow]
            entries.append((hour, flow, qty, pick.randrange(20) if flow == "set" else None))
        rows += ledger_rows(entries, loc)
    return rows


@pytest.mark.parametrize("seed, least, limit, block", [(1, 0, 4_000_000, 64), (2, 0, 7, 3), (3, -4, 4_000_000, 3), (4, -4, 7, 64)])
def test_lots_on_hand_equal_all_lots_that_have_units_left(spark, monkeypatch, seed, least, limit, block):
    """``least`` below 0 brings lots that take units away; lots of no units are among them always."""
    monkeypatch.setattr(trace, "BLOCK_LOTS", block)
    raw = spark.createDataFrame(histories(seed, least), LEDGER)
    shape = Shape.of(raw, limit)
    assert shape.negative_lots == (least < 0) and (shape.long_runs is None) == (limit > 100)
    ledger = mark_segments(sequence_ledger(raw, shape), shape).cache()
    adjustments, chosen = set_adjustments(ledger, shape).cache(), ledger.select("loc", "item", "u")
    got = trace.lots_on_hand(ledger, adjustments, chosen, shape)
    pairs = trace.fifo_remaining(trace.expand_lots(ledger, adjustments, chosen, shape), shape)
    left = [f"{a}{p}septa" for a in ("", "a_") for p in ("", "aj_", "naj_", "faj_")]
    want = pairs.filter(" or ".join(f"{c} <> 0" for c in left))
    told = lambda df: sorted((tuple(r) for r in df.select(*sorted(want.columns)).collect()), key=repr)
    assert set(got.columns) == set(want.columns) and told(got) == told(want) != []
    assert got.filter("a_septa <> septa").count() > 0


def test_rows_meet_blocks_of_lots_only(spark):
    raw = spark.createDataFrame(histories(1, 1), LEDGER)
    shape = Shape.of(raw)
    ledger = mark_segments(sequence_ledger(raw, shape), shape)
    rows = trace.lots_on_hand(ledger, set_adjustments(ledger, shape), ledger.filter("flow = 'out'").select("loc", "item", "u"), shape)
    text = rows._jdf.queryExecution().optimizedPlan().toString()
    pairing = [line for line in text.splitlines() if "Join Inner" in line and "lot_u" not in line and "u#" not in line.replace("lot_u#", "")]
    assert pairing and all("block#" in line or "cr_set#" in line for line in pairing)
    assert trace.lots_on_hand(ledger, set_adjustments(ledger, shape), ledger.filter(F.lit(False)).select("loc", "item", "u"), shape).count() == 0
