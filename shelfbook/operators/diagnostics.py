"""Reports on the ledgers themselves (K1-K5)."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfbook.functions.clock import moment, years_between
from shelfbook.operators.scan import RUN_LIMIT, Measure, find_long_runs, scan


def rows_per_day(ledgers: Mapping[str, DataFrame], ts: str) -> DataFrame:
    """Rows per ledger and day of ``ts`` (of loading or of the activity)."""
    parts = [
        ledger.groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("num_rows")).select(
            F.lit(name).alias("ledger"), "day", "num_rows"
        )
        for name, ledger in ledgers.items()
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("day", "ledger")


def item_footprint(ledgers: Mapping[str, DataFrame]) -> DataFrame:
    """First and last activity and number of rows per ledger and item."""
    parts = [
        ledger.groupBy("item").agg(
            F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"), F.count(F.lit(1)).alias("num_rows")
        ).select(F.lit(name).alias("ledger"), "item", "min_ts", "max_ts", "num_rows")
        for name, ledger in ledgers.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def rank_footprint(footprint: DataFrame, as_of: datetime, limit: int = RUN_LIMIT) -> DataFrame:
    """Calendar years since first and last activity, and the rank by rows within each ledger.

    Items with equal rows are ranked by code. A ledger holds a whole catalogue, so a long one is ranked
    in pieces.
    """
    order = [("num_rows", "desc"), ("item", "asc")]
    rank = Measure("item_idx", "count", F.lit(1))
    ranked = scan(footprint, ["ledger"], order, [rank], find_long_runs(footprint, ["ledger"], limit))
    now = moment(as_of)
    return ranked.withColumns(
        {"yrs_old": years_between(F.col("min_ts"), now), "yrs_inac": years_between(F.col("max_ts"), now)}
    )


def load_lag(ledger: DataFrame) -> DataFrame:
    """Per day of loading: the latest activity other than direct deliveries, and the next start."""
    return ledger.groupBy(F.to_date("last_update").alias("day")).agg(
        F.max(F.when(~F.col("xacn").isin("CDC", "Drps"), F.col("ts"))).alias("last_ts"),
        F.date_sub(F.to_date(F.max("last_update")), 2).alias("new_start"),
        F.count(F.lit(1)).alias("num_records"),
    )
