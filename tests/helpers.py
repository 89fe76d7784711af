"""Small ledgers and a plain-Python reading of the age rules, for comparison."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

LEDGER = (
    "loc string, item_code string, item string, sku_ext string, shpmt string, ts timestamp_ntz, "
    "xacn string, flow string, qty bigint, inv bigint"
)
START = datetime(2020, 1, 1)


def ledger_rows(entries, loc="00001", item="A"):
    """Entries of (hour, flow, qty, inv) -> ledger rows without place."""
    xacn = {"in": "CDC", "out": "Sale", "set": "SICC"}
    return [
        (loc, item, item, "0", f"s{i:06d}", START + timedelta(hours=h), xacn[f], f, q, v)
        for i, (h, f, q, v) in enumerate(entries)
    ]


def micro(value):
    return Decimal(value).quantize(Decimal("0.000001"), ROUND_HALF_UP)


def plain_ages(rows, adjustments):
    """Pairs every row with all of its lots. ``rows``: dicts of one run in order of u."""
    variants = (("", None), ("aj_", "adj_q"), ("naj_", "n_adj_q"), ("faj_", "f_adj_q"))
    result = {}
    for n in rows:
        adj = adjustments.get((n["loc"], n["item_code"], n["item"], n["cr_set"], n["nx_in"]))
        lots = [r for r in rows if r["flow"] == "in" and r["u"] <= n["u"]]
        if adj is None or not lots:
            continue
        own = n["qty"] if n["flow"] == "in" else 0
        out = {}
        for prefix, name in variants:
            shift = 0 if name is None else adj[name]
            before = n["inv_q"] - (n["qty"] or 0) + shift
            after = n["inv_q"] + shift
            total = spent = units = 0
            running, held = 0, []
            days = Decimal(0)
            moved = Decimal(0)
            for i, lot in enumerate(lots):
                hours = int((n["ts"].replace(minute=0) - lot["ts"].replace(minute=0)).total_seconds() // 3600)
                age = micro(Decimal(hours) / 24)
                btd = sum(x["qty"] for x in lots[i:]) - own

                def left(q, btd=btd, lot=lot):
                    if btd == 0:
                        return 0
                    return lot["qty"] if q >= btd else max(0, q - btd + lot["qty"])

                septa = left(before)
                rest = septa if n["flow"] == "in" else left(after)
                running += septa
                days += age * septa
                units += septa
                if n["flow"] == "out":
                    moved += age * (septa - rest)
                if septa != 0:
                    held.append((running, age))
            oldest = lambda need: max((a for r, a in held if need <= r), default=None)
            if before % 2 == 0:
                half = int(before / 2)
                a, b = oldest(half + 1), oldest(half)
                median = None if a is None or b is None else (a + b) / 2
            else:
                median = oldest(before / 2)
            out[prefix] = {
                "inv_days": days,
                "a_inv_age": micro(days / units) if units else None,
                "m_inv_age": median,
                "qty_days": int(moved),
                "qty_age": micro(moved / abs(n["qty"])) if n["qty"] else None,
            }
        result[(n["loc"], n["item"], n["u"])] = out
    return result
