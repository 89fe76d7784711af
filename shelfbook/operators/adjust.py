"""Count adjustments per segment of the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfbook.operators.scan import Measure
from shelfbook.operators.sequence import RUN, Shape, over_runs

ADJUST_KEY = ("loc", "item_code", "item", "cr_set", "nx_in")


def adjustment_rows(ledger: DataFrame, shape: Shape | None = None) -> DataFrame:
    """Row-level corrections (E1-E5), one row per ledger row.

    ``adj_q`` is constant within a segment, so every extreme of the adjusted quantity is the extreme of
    the book quantity plus ``adj_q``; and ``nx_in`` never falls as ``u`` rises, so both running minima
    share the order of ``u``. One pass serves all five columns.
    """
    shape = shape or Shape.of(ledger)
    inv_q = F.col("inv_q")
    measures = [
        Measure("adj_q", "sum", F.coalesce(F.col("inv") - inv_q, F.lit(0)), "all"),
        Measure("min_inv_q", "min", inv_q, "all"),
        Measure("_low", "min", inv_q),
    ]
    rows = over_runs(ledger, (*RUN, "cr_set"), measures, shape)
    adj_q, low, lowest = F.col("adj_q"), F.col("_low"), F.col("min_inv_q")
    fine, not_yet = lowest + adj_q >= 0, low + adj_q >= 0
    return rows.select(
        *[c for c in rows.columns if c != "_low"],
        (lowest + adj_q).alias("min_a_inv_q"),
        F.when(fine | not_yet, adj_q).otherwise(-low).alias("n_adj_q"),
        F.when(fine | not_yet, adj_q).otherwise(-lowest).alias("f_adj_q"),
        F.when(fine, 0).when(not_yet, 1).otherwise(2).alias("f_cc"),
    )


def set_adjustments(ledger: DataFrame, shape: Shape | None = None, item_in_key: bool = True) -> DataFrame:
    """One row per (loc, item_code, item, cr_set, nx_in) with the largest adjustments seen there.

    ``item_in_key=False`` gives the older shape without the item column.
    """
    rows = adjustment_rows(ledger, shape)
    key = [k for k in ADJUST_KEY if item_in_key or k != "item"]
    grouped = rows.groupBy(*key, "adj_q", "min_inv_q", "min_a_inv_q").agg(
        F.max("n_adj_q").alias("n_adj_q"), F.max("f_adj_q").alias("f_adj_q"), F.max("f_cc").alias("f_cc")
    )

    def share(column: str):
        lowest = F.nullif(F.col("min_inv_q"), F.lit(0)).cast("decimal(19,0)")
        ratio = F.col(column).cast("decimal(19,0)") * F.lit("1.0").cast("decimal(2,1)") / lowest
        return F.abs(ratio.cast("decimal(38,12)"))

    return grouped.withColumns(
        {
            "span": F.col("nx_in") - F.col("cr_set"),
            "pct_adj": share("adj_q"),
            "f_pct_adj": share("f_adj_q"),
        }
    )
