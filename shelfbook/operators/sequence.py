"""Order of the ledger within a location and item, and the markers that follow from it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfbook.operators.scan import RUN_LIMIT, LongRuns, Measure, chunked, find_long_runs, scan, windowed
from shelfbook.session import buckets_for, durable, durable_by

RUN = ("loc", "item")
LEDGER_ORDER = (
    ("ts", "asc"),
    ("item_code", "desc"),
    ("sku_ext", "asc"),
    ("shpmt", "asc"),
    ("xacn", "asc"),
)


@dataclass(frozen=True)
class Shape:
    """What the choice of plan needs to know about a ledger; found once and passed along."""

    long_runs: LongRuns | None = None
    negative_lots: bool = False
    limit: int = RUN_LIMIT
    rows: int = 0

    @classmethod
    def of(cls, ledger: DataFrame, limit: int = RUN_LIMIT) -> Shape:
        """Three small answers from one pass over (loc, item, flow, qty)."""
        counts = ledger.groupBy(*RUN).agg(
            F.count(F.lit(1)).alias("_rows"),
            F.min(F.when(F.col("flow") == "in", F.col("qty"))).alias("_least"),
        )
        longest, least, total = counts.agg(F.max("_rows"), F.min("_least"), F.sum("_rows")).first()
        runs = find_long_runs(ledger, RUN, limit) if (longest or 0) > limit else None
        return cls(runs, (least or 0) < 0, limit, total or 0)

    def deal(self, rows: DataFrame) -> DataFrame:
        """``rows`` of the ledger, or of a part of it, dealt by run as ``store`` keeps them. Pieces of long runs stay apart."""
        return rows if self.long_runs else rows.repartition(buckets_for(rows.sparkSession, self.rows), *RUN)

    def store(self, rows: DataFrame, sort: Sequence[str] = ()) -> DataFrame:
        """A staging table of rows that were dealt by run, or that follow from such a table: later steps need no shuffle."""
        if self.long_runs:
            return durable(rows)
        return durable_by(rows, RUN, buckets_for(rows.sparkSession, self.rows), sort)

    def piece(self):
        """Number of the piece a row belongs to, from its place in the run."""
        return F.floor((F.col("u") - 1) / self.limit).cast("bigint")


def over_runs(df: DataFrame, keys, measures, shape: Shape, short_order=(("u", "asc"),)) -> DataFrame:
    """Measures in order of ``u``; once ``u`` is known, long runs are cut by plain arithmetic on it.

    ``short_order`` is the order that gave ``u``, where it was given in the same plan: without long runs the rows then are in place.
    """
    order = [("u", "asc")]
    if shape.long_runs is None:
        return windowed(df, keys, short_order, measures)
    return chunked(df.withColumn("_piece", shape.piece()), keys, "_piece", order, measures).drop("_piece")


def sequence_ledger(ledger: DataFrame, shape: Shape | None = None) -> DataFrame:
    """Adds ``u`` (1-based place in the run) and ``inv_q`` (running book quantity)."""
    rows = ledger.drop("u", "inv_q", "cr_set", "nx_in")
    shape = shape or Shape.of(rows)
    measures = [Measure("u", "count", F.lit(1)), Measure("inv_q", "sum", F.col("qty"))]
    return scan(rows, RUN, LEDGER_ORDER, measures, shape.long_runs)


def mark_segments(ledger: DataFrame, shape: Shape | None = None, short_order=(("u", "asc"),)) -> DataFrame:
    """Adds ``cr_set`` (place of the count in force, else 1) and ``nx_in`` (place of the next inbound
    row, else of the next count, else of the last row)."""
    shape = shape or Shape.of(ledger)
    u, flow = F.col("u"), F.col("flow")
    measures = [
        Measure("_count", "max", F.when(flow == "set", u)),
        Measure("_next_in", "next", "_in"),
        Measure("_next_set", "next", "_set"),
        Measure("_rows", "max", u, "all"),
    ]
    rows = ledger.drop("cr_set", "nx_in").withColumns({"_in": F.when(flow == "in", u), "_set": F.when(flow == "set", u)})
    marked = over_runs(rows, RUN, measures, shape, short_order)
    return marked.select(
        *[c for c in marked.columns if not c.startswith("_")],
        F.coalesce("_count", F.lit(1).cast("bigint")).alias("cr_set"),
        F.coalesce("_next_in", "_next_set", "_rows").alias("nx_in"),
    )


def order_runs(rows: DataFrame, shape: Shape) -> DataFrame:
    """The ledger in order and with its markers, as a staging table that lies by run."""
    return shape.store(mark_segments(sequence_ledger(shape.deal(rows), shape), shape, LEDGER_ORDER), ["u"])
