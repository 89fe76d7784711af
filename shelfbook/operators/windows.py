"""Load windows and the items that ignore their lower bound."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfbook.config import Window, day_start, fixed_window
from shelfbook.functions.clock import moment


def load_window(policy: str, as_of: datetime, ledger: DataFrame | None = None) -> Window:
    """Since-last-update starts two days before the latest update; an empty ledger gives no start, so
    only new items pass, and then every item is new."""
    if policy != "since_last_update":
        return fixed_window(policy, as_of)
    last = ledger.agg(F.max("last_update")).first()[0]
    return Window(day_start(last - timedelta(days=2)) if last else None, day_start(as_of))


def new_items(items: DataFrame, ledger: DataFrame) -> DataFrame:
    """Followed codes without any ledger row."""
    return items.select("item_code").join(ledger.select("item_code").distinct(), "item_code", "left_anti")


def in_window(
    df: DataFrame,
    ts: str,
    window: Window,
    fresh: DataFrame,
    code: str = "item_code",
    heads: DataFrame | None = None,
    on: Sequence[str] = (),
) -> DataFrame:
    """Rows inside the window, and earlier rows of new items; with ``heads`` also joined to those by ``on``.

    Two branches instead of one either-or filter: the first is a plain date range that reaches the scan,
    the second disappears at run time when there are no new items. Rows that meet heads are read, shuffled and joined
    once, with a mark at new items, as two branches would do all that twice.
    """
    at = F.col(ts)
    known = fresh.select(F.col("item_code").alias(code))
    if window.start is None:
        rows = df.join(known, code, "left_semi")
        return (rows if heads is None else rows.join(heads, list(on))).filter(at < moment(window.end))
    if heads is not None:
        marked = df.join(known.distinct().withColumn("_new", F.lit(True)), code, "left").join(heads, list(on))
        return marked.filter((at < moment(window.end)) & ((at >= moment(window.start)) | F.col("_new"))).drop("_new")
    recent = df.filter((at >= moment(window.start)) & (at < moment(window.end)))
    start = min(window.start, window.end)
    older = df.join(known, code, "left_semi").filter(at < moment(start))
    return recent.unionByName(older)
