"""Running aggregates over ordered groups of any size.

A plain window sends a whole group to one task. That is the best plan as long as every group fits
there, and ``windowed`` is exactly that. A group beyond ``RUN_LIMIT`` rows is cut into ordered pieces
instead: each piece is aggregated on its own, one total per piece is carried to the pieces after (or
before) it, and each row combines its local value with the carried one. Results are the same.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfbook.session import durable

RUN_LIMIT = 4_000_000  # rows of one group that one task may sort
LIST_LIMIT = 1_000_000  # long a list of group keys may be broadcast

Order = Sequence[tuple[str, str]]  # (column, "asc" | "desc")

_FOLDS = {
    "sum": F.sum,
    "count": F.count,
    "min": F.min,
    "max": F.max,
    "last": lambda c: F.last(c, ignorenulls=True),
}


@dataclass(frozen=True)
class Measure:
    """``kind`` of ``value`` over a span of rows: through (and with) the row, before, after, or all.

    ``next`` is the first known value after the row; its value is the name of a column.
    """

    name: str
    kind: str
    value: Column | str
    span: str = "through"


@dataclass(frozen=True)
class LongRuns:
    """The groups that hold more than ``limit`` rows; there are fewer than rows / limit of them."""

    keys: tuple[str, ...]
    table: DataFrame
    groups: int
    rows: int
    limit: int

    def listed(self) -> DataFrame:
        table = self.table.select(*self.keys)
        return F.broadcast(table) if self.groups <= LIST_LIMIT else table


def find_long_runs(df: DataFrame, keys: Sequence[str], limit: int = RUN_LIMIT) -> LongRuns | None:
    """One counting pass (combined before its shuffle), kept; None when every group is short enough."""
    table = durable(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > limit))
    groups, rows = table.agg(F.count(F.lit(1)), F.sum("_rows")).first()
    return LongRuns(tuple(keys), table, groups, rows, limit) if groups else None


def _ordering(order: Order, flip: bool = False) -> list[Column]:
    return [F.desc(c) if (d == "desc") != flip else F.asc(c) for c, d in order]


def _over(measure: Measure, keys: Sequence[str], order: Order) -> Column:
    window = Window.partitionBy(*keys)
    if measure.kind == "next":
        # Read forwards, with the sort of the other frames.
        return F.expr(f"lead({measure.value}) IGNORE NULLS").over(window.orderBy(*_ordering(order)))
    if measure.span == "after":
        # A frame that ends at the last row is evaluated afresh for every row; the same frame read
        # backwards is a running one.
        window = window.orderBy(*_ordering(order, flip=True)).rowsBetween(Window.unboundedPreceding, -1)
    elif measure.span == "before":
        window = window.orderBy(*_ordering(order)).rowsBetween(Window.unboundedPreceding, -1)
    elif measure.span == "through":
        window = window.orderBy(*_ordering(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    else:
        # The order changes nothing here but lets Spark use one sort for all of these frames.
        window = window.orderBy(*_ordering(order)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return _FOLDS[measure.kind](measure.value).over(window)


def windowed(df: DataFrame, keys: Sequence[str], order: Order, measures: Sequence[Measure]) -> DataFrame:
    return df.select("*", *[_over(m, keys, order).alias(m.name) for m in measures])


def _combined(measure: Measure, local: Column, carried: Column) -> Column:
    if measure.span == "all":
        return carried
    if measure.kind in ("sum", "count"):
        zero = F.lit(0)
        both = F.coalesce(local, zero) + F.coalesce(carried, zero)
        return F.when(local.isNotNull() | carried.isNotNull(), both)
    if measure.kind in ("last", "next"):
        return F.coalesce(local, carried)
    return (F.least if measure.kind == "min" else F.greatest)(local, carried)


def _total(measure: Measure, order: Order) -> Column:
    """Aggregate of a whole piece; the latest (or first) value is the one at the greatest (least) place, not the last read."""
    if measure.kind not in ("last", "next"):
        return _FOLDS[measure.kind](measure.value)
    if any(direction != "asc" for _, direction in order):
        raise ValueError("latest and next values are only carried in ascending order")
    value = F.col(measure.value) if measure.kind == "next" else measure.value
    pick = F.min_by if measure.kind == "next" else F.max_by
    return pick(value, F.when(value.isNotNull(), F.struct(*[c for c, _ in order])))


def chunked(
    df: DataFrame, keys: Sequence[str], chunk: str, order: Order, measures: Sequence[Measure]
) -> DataFrame:
    """As ``windowed``, for groups cut into pieces numbered by ``chunk`` in the same order."""
    place = [*keys, chunk]
    local = windowed(df, place, order, [m for m in measures if m.span != "all"])
    totals = df.groupBy(*place).agg(*[_total(m, order).alias(m.name) for m in measures])
    carries = []
    for m in measures:
        kind = "sum" if m.kind == "count" else m.kind
        carries.append(
            _over(
                Measure(m.name, kind, m.name if kind == "next" else F.col(m.name), "before" if m.span == "through" else m.span),
                keys,
                [(chunk, "asc")],
            ).alias(f"_carried_{m.name}")
        )
    # few rows; dealt by piece, so that the pieces of a group are not brought together for the join
    carried = totals.select(*place, *carries).repartition(*place)
    names = {m.name for m in measures}
    return local.join(carried, place, "left").select(
        *[c for c in df.columns if c not in names],
        *[_combined(m, F.col(m.name) if m.span != "all" else None, F.col(f"_carried_{m.name}")).alias(m.name)
          for m in measures],
    )


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Order,
    measures: Sequence[Measure],
    long_runs: LongRuns | None = None,
    tie: Sequence[str] = (),
) -> DataFrame:
    """``windowed`` for the short groups; the long ones are range-split on their order first.

    ``tie`` names further columns that may separate rows of equal order when ranges are cut.
    """
    if long_runs is None:
        return windowed(df, keys, order, measures)
    listed = long_runs.listed()
    run = list(long_runs.keys)  # ``keys`` may be finer than the runs that were counted
    short = df.join(listed, run, "left_anti")
    long = df.join(listed, run, "left_semi")
    parts = max(2, math.ceil(4 * long_runs.rows / long_runs.limit))
    pieces = long.repartitionByRange(
        parts, *[F.col(k) for k in keys], *_ordering(order), *[F.col(t) for t in tie]
    )
    pieces = durable(pieces.withColumn("_piece", F.spark_partition_id()))
    spread = chunked(pieces, keys, "_piece", order, measures).drop("_piece")
    return windowed(short, keys, order, measures).unionByName(spread)
