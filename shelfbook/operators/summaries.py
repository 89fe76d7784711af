"""The reports on a ledger (K1-K5) from small cells that a load brings up to date.

A cell counts the rows of one run, (loc, item), with one day of activity, one day of loading and one kind of row, and keeps
their earliest and latest moments. Cells add up to every report, so the ledger itself is not read again for them. What a
load adds or corrects lies at or after the first changed moment of its run (``Merged.runs``): the cells from that day on are
counted anew from the touched runs, and all others stay. So a corrected row leaves its old cell without any subtraction,
and earliest and latest moments, which cannot be subtracted, stay exact.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfbook.operators.lookup import lookup_join
from shelfbook.operators.merge import LedgerStore, Merged, at
from shelfbook.operators.sequence import RUN


def cells(ledger: DataFrame) -> DataFrame:
    """One row per (loc, item, day, update_day, direct); ``direct`` marks direct deliveries. Days may be null."""
    return ledger.groupBy(
        *RUN, F.to_date("ts").alias("day"), F.to_date("last_update").alias("update_day"), F.col("xacn").isin("CDC", "Drps").alias("direct")
    ).agg(
        F.count(F.lit(1)).alias("num_rows"), F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"), F.max("last_update").alias("max_update")
    )


def refresh_cells(store: LedgerStore, merged: Merged, before: DataFrame) -> DataFrame:
    """``before``, the cells of the ledger before the load -> those after it. Reads the touched buckets only."""
    state = merged.runs.select(*RUN, F.to_date("first").alias("from_day"))
    kept = lookup_join(before, state, RUN, "left").filter(
        F.col("from_day").isNull() | (F.to_date(at(F.col("day").cast("timestamp_ntz"))) < F.col("from_day"))
    )
    rows = store.read().filter(F.col("bucket").isin(merged.buckets))
    changed = lookup_join(rows, state, RUN).filter(F.to_date(at(F.col("ts"))) >= F.col("from_day"))
    return kept.select(*before.columns).unionByName(cells(changed))


def rows_per_day(ledgers: Mapping[str, DataFrame], day: str) -> DataFrame:
    """Rows per ledger and ``day`` ("day" of activity or "update_day"), from the cells of each ledger."""
    parts = [
        own.groupBy(F.col(day).alias("day")).agg(F.sum("num_rows").alias("num_rows")).select(F.lit(name).alias("ledger"), "day", "num_rows")
        for name, own in ledgers.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def item_footprint(ledgers: Mapping[str, DataFrame]) -> DataFrame:
    """First and last activity and number of rows per ledger and item, from the cells of each ledger."""
    parts = [
        own.groupBy("item").agg(F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts"), F.sum("num_rows").alias("num_rows"))
        .select(F.lit(name).alias("ledger"), "item", "min_ts", "max_ts", "num_rows")
        for name, own in ledgers.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def load_lag(own: DataFrame) -> DataFrame:
    """Per day of loading: the latest activity other than direct deliveries, and the next start."""
    return own.groupBy(F.col("update_day").alias("day")).agg(
        F.max(F.when(~F.col("direct"), F.col("max_ts"))).alias("last_ts"),
        F.date_sub(F.to_date(F.max("max_update")), 2).alias("new_start"),
        F.sum("num_rows").alias("num_records"),
    )
