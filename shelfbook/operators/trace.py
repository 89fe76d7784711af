"""The lots behind chosen ledger rows, for checking ages by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfbook.operators.ages import (
    VARIANTS,
    age_micros,
    ages,
    as_days,
    inbound_lots,
    lot_positions,
    plus,
    quantities,
    with_adjustments,
)
from shelfbook.operators.lookup import lookup_join
from shelfbook.operators.scan import Measure, scan
from shelfbook.operators.sequence import RUN, Shape, over_runs

PLACE = (*RUN, "u")
BLOCK_LOTS = 64  # lots of a run that a chosen row meets together


def closing_rows(ledger: DataFrame, shape: Shape | None = None) -> DataFrame:
    """The last ledger row of every (loc, item): what stands on the shelf now."""
    return ledger.groupBy(*RUN).agg(F.max("u").alias("u"))


def _rows_and_lots(ledger: DataFrame, adjustments: DataFrame, chosen: DataFrame, shape: Shape) -> tuple[DataFrame, DataFrame]:
    """The chosen rows with their book quantities, and all lots with their reverse rank; both with the units before them."""
    placed = lot_positions(ledger, shape)
    rows = with_adjustments(placed.join(chosen.select(*PLACE), list(PLACE), "left_semi"), adjustments, shape)
    rows = plus(rows, quantities()).select(
        *PLACE, "item_code", "sku_ext", "xacn", "ts", "flow", "qty", "inv", "inv_q", "n_adj_q", "f_adj_q", "adj_q",
        "hour", "b_units", *quantities(), F.col("lots").alias("last_lot"), F.col("negative_lots").alias("uneven"),
    )
    starts = placed.filter(F.col("flow") == "in").select(
        *RUN, F.col("u").alias("lot_u"), F.col("ts").alias("in_ts"), F.col("hour").alias("in_hour"),
        F.col("qty").alias("in_qty"), F.col("b_units").alias("start"), F.col("lots").alias("lot"),
        F.col("negative_lots").alias("lot_uneven"),
    )
    every = Measure("_lots", "count", F.lit(1), "all")
    ranked = over_runs(starts.withColumnRenamed("lot_u", "u"), RUN, [every], shape)
    return rows, ranked.withColumnRenamed("u", "lot_u").withColumn("d_in_u", F.col("_lots") - F.col("lot") + 1).drop("_lots")


def _paired(pairs: DataFrame) -> DataFrame:
    """Age of the lot and units received since its start, in place of the figures that they come from."""
    figures = {"in_age": as_days(age_micros("hour - in_hour")), "btd_in_qty": "b_units - start"}
    return plus(pairs, figures).drop("start", "hour", "in_hour", "b_units", "lot", "last_lot", "uneven", "lot_uneven")


def expand_lots(
    ledger: DataFrame, adjustments: DataFrame, chosen: DataFrame, shape: Shape | None = None
) -> DataFrame:
    """Each chosen row (loc, item, u) with every lot up to it.

    One row per chosen row and lot, so choose rows, not whole histories: with one row per run, as
    ``closing_rows`` gives, every lot appears once.
    """
    shape = shape or Shape.of(ledger)
    rows, lots = _rows_and_lots(ledger, adjustments, chosen, shape)
    pairs = lookup_join(lots, rows, RUN).filter(F.col("lot_u") <= F.col("u"))
    return _paired(pairs)


def _left_of_lot(on_book: str) -> str:
    """The lot less those of its units that lie below the floor; unknown where the book is."""
    below = f"(btd_in_qty - {on_book})"
    gone = f"CASE WHEN {below} > 0 THEN least({below}, in_qty) WHEN {below} <= 0 THEN 0L END"
    return f"if(btd_in_qty = 0, 0L, in_qty - {gone})"


def _remaining() -> dict[str, str]:
    return {f"{p}septa": _left_of_lot(f"{p}before") for p, _ in VARIANTS}


def _remaining_after() -> dict[str, str]:
    return {f"a_{p}septa": f"CASE WHEN flow <> 'in' THEN {_left_of_lot(f'{p}after')} ELSE {p}septa END" for p, _ in VARIANTS}


def fifo_remaining(pairs: DataFrame, shape: Shape) -> DataFrame:
    """Units left of each lot before (``septa``) and after (``a_septa``) the activity, and the units left
    from the oldest lot to this one (``ru_septa``), per variant."""
    running = [Measure(f"ru_{p}septa", "sum", F.col(f"{p}septa")) for p, _ in VARIANTS]
    left = plus(plus(pairs, _remaining()), _remaining_after())
    return scan(left, PLACE, [("d_in_u", "desc")], running, shape.long_runs)


def _first_lots(rows: DataFrame, lots: DataFrame, shape: Shape) -> DataFrame:
    """``rows`` before any negative lot that have units on hand, with the number of their oldest lot (``first_lot``).

    In position order, the latest lot that starts at or below a row's lowest floor holds its oldest unit.
    """
    books = [*(f"{p}before" for p, _ in VARIANTS), *(f"{p}after" for p, _ in VARIANTS)]
    asked = plus(rows.filter("uneven = 0"), {"floor": f"b_units - greatest({', '.join(books)})"}).filter("floor < b_units")
    asked = asked.withColumn("floor", F.greatest("floor", F.lit(0)))
    runs = asked.select(*RUN).distinct()
    own = lookup_join(lots.filter("lot_uneven = 0"), runs, RUN, "left_semi")
    events = asked.select(*RUN, "u", F.col("floor").alias("place"), F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("lot")).unionByName(
        own.select(*RUN, F.col("lot_u").alias("u"), F.col("start").alias("place"), F.lit(0).alias("kind"), "lot")
    )
    holder = Measure("first_lot", "last", F.col("lot"))
    held = scan(events, RUN, [("place", "asc"), ("kind", "asc")], [holder], shape.long_runs, tie=["u"])
    return asked.drop("floor").join(held.filter("kind = 1").select(*PLACE, "first_lot"), list(PLACE))


def lots_on_hand(ledger: DataFrame, adjustments: DataFrame, chosen: DataFrame, shape: Shape | None = None) -> DataFrame:
    """Each chosen row (loc, item, u) with the lots of which units are left before or after it, in any variant.

    Any rows may be chosen, whole histories too: a row meets only the blocks of lots from its oldest one on hand up to its own
    place, so work grows with lots on hand. The running units of a lot follow from its place above the floor. Rows after a
    negative lot meet all lots of their run up to them, and their running units are summed.
    """
    shape = shape or Shape.of(ledger)
    # Both are read by several steps.
    rows, lots = (shape.store(table) for table in _rows_and_lots(ledger, adjustments, chosen, shape))
    block = lambda number: F.floor((F.col(number) - 1) / BLOCK_LOTS)
    asked = _first_lots(rows, lots, shape).withColumn("block", F.explode(F.sequence(block("first_lot"), block("last_lot"))))
    met = lookup_join(lots.withColumn("block", block("lot")), asked, (*RUN, "block")).drop("block")
    met = met.filter("lot between first_lot and last_lot").drop("first_lot")
    # The units held from the oldest lot to this one reach from the floor to where the next lot starts, or to the row's own place.
    running = {
        f"ru_{p}septa": f"CASE WHEN {p}before IS NOT NULL THEN "
        f"greatest(0L, least(start + in_qty, b_units) - greatest(b_units - {p}before, 0L)) END"
        for p, _ in VARIANTS
    }
    left = plus(plus(_paired(plus(met, running)), _remaining()), _remaining_after())
    if shape.negative_lots:
        after_negative = rows.filter("uneven > 0")
        pairs = _paired(lookup_join(lots, after_negative, RUN).filter(F.col("lot_u") <= F.col("u")))
        left = left.unionByName(fifo_remaining(pairs, shape))
    counted = [f"{prefix}{p}septa" for p, _ in VARIANTS for prefix in ("", "a_")]
    return left.filter(" OR ".join(f"{name} <> 0" for name in counted))


def trace_ages(
    ledger: DataFrame, adjustments: DataFrame, chosen: DataFrame, shape: Shape | None = None
) -> DataFrame:
    """Lots of the chosen rows with their units left, next to the resulting ages."""
    shape = shape or Shape.of(ledger)
    lots = fifo_remaining(expand_lots(ledger, adjustments, chosen, shape), shape)
    totals = ages(ledger, adjustments, shape, chosen).drop(
        "item_code", "sku_ext", "xacn", "ts", "flow", "qty"
    )
    return lookup_join(lots, totals, PLACE)


def trace_book(
    ledger: DataFrame, adjustments: DataFrame, chosen: DataFrame, shape: Shape | None = None
) -> DataFrame:
    """The older trace: book variant only, starting from the counted quantity where there is one, and
    showing the inbound total with the row's own quantity still in it."""
    shape = shape or Shape.of(ledger)
    pairs = expand_lots(ledger, adjustments, chosen, shape)
    pairs = plus(
        pairs,
        {
            "ba_inv_q": "coalesce(inv, inv_q) - qty",
            "a_inv_q": "coalesce(inv, inv_q) + adj_q",
            "f_inv_q": "coalesce(inv, inv_q) + f_adj_q",
            "td_in_qty": "btd_in_qty + CASE WHEN flow = 'in' THEN qty ELSE 0 END",
        },
    )
    left = plus(pairs, {"septa": _left_of_lot("ba_inv_q")})
    running = [Measure("ru_septa", "sum", F.col("septa"))]
    traced = scan(left, PLACE, [("d_in_u", "desc")], running, shape.long_runs)
    return traced.select(
        *PLACE, "item_code", "sku_ext", "xacn", "ts", "qty", "inv_q", "n_adj_q", "f_adj_q", "in_age", "d_in_u", "in_ts",
        "ba_inv_q", "a_inv_q", "f_inv_q", "in_qty", "td_in_qty", "btd_in_qty", "septa", "ru_septa",
    )
