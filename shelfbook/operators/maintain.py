"""Keeping the ledger in step with its sources (D1-D3), and key checks before a write."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfbook.functions.clock import moment
from shelfbook.operators.activity import ACTIVITY_SCHEMA, LEDGER_KEY
from shelfbook.operators.inbound import DETAIL_KEY
from shelfbook.operators.lookup import lookup_join

LEDGER_COLUMNS = (*ACTIVITY_SCHEMA, "n", "last_update", "item")


def assert_unique(df: DataFrame, key: Sequence[str], what: str) -> None:
    repeated = df.groupBy(*key).count().filter("count > 1").limit(5).collect()
    if repeated:
        raise ValueError(f"{what}: repeated keys, e.g. {[tuple(r[k] for k in key) for r in repeated]}")


def assert_unique_in_runs(df: DataFrame, run: Sequence[str], key: Sequence[str], what: str) -> None:
    """As ``assert_unique`` for rows that lie by ``run``, (loc, item): where each code of a location has one item, equal keys meet
    within a run, so that only the codes are shuffled and not the rows."""
    codes = df.select(*run, "item_code").distinct()
    split = codes.groupBy("loc", "item_code").count().filter("count > 1").limit(1).collect()
    assert_unique(df, key if split else [*key, *[c for c in run if c not in key]], what)


SYNCED = ("ts", "qty", "psh_qty")


def news_of(detail: DataFrame) -> DataFrame:
    """What ``sync_inbound`` reads of the detail: keys and, as ``new_...``, the fields it carries over."""
    return detail.select(*DETAIL_KEY, *[F.col(f).alias(f"new_{f}") for f in SYNCED])


def differing() -> Column:
    """Whether a row that met its news differs from it; changes from or to an unknown value are not changes."""
    return reduce(Column.__or__, [F.coalesce(F.col(f) != F.col(f"new_{f}"), F.lit(False)) for f in SYNCED])


def with_news(rows: DataFrame, news: DataFrame, key: Sequence[str], run_ts: datetime) -> DataFrame:
    """``rows`` with the fields of their ``news`` (by ``key``) where these differ."""
    joined = rows.join(news, list(key), "left")
    changed = {f: F.when(differing(), F.col(f"new_{f}")).otherwise(F.col(f)) for f in SYNCED}
    changed["last_update"] = F.when(differing(), moment(run_ts)).otherwise(F.col("last_update"))
    return joined.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in rows.columns])


def sync_inbound(ledger: DataFrame, detail: DataFrame, run_ts: datetime) -> DataFrame:
    """Carry changed date, quantity and push quantity of inbound rows into the ledger.

    Changes from or to an unknown value are not changes.
    """
    # Rows that are not shipments cannot match, and would all meet under one key.
    shipped = ledger.filter(F.col("shpmt") != "na")
    return with_news(shipped, news_of(detail), DETAIL_KEY, run_ts).unionByName(ledger.filter(F.col("shpmt") == "na"))


def fresh_inbound(ledger: DataFrame, detail: DataFrame, items: DataFrame, run_ts: datetime) -> DataFrame:
    """Inbound rows whose (code, location, shipment) the ledger does not have, as ledger rows."""
    known = ledger.filter(F.col("shpmt") != "na").select(*DETAIL_KEY)
    fresh = detail.join(known, list(DETAIL_KEY), "left_anti")
    rows = lookup_join(fresh, items.select("item_code", "item"), ["item_code"])
    given = {
        "sku_ext": F.lit("0"),
        "flow": F.lit("in"),
        **{c: F.col(c) for c in (*DETAIL_KEY, "ts", "xacn", "qty", "psh_qty")},
    }
    return rows.select(
        *[given.get(c, F.lit(None)).cast(t).alias(c) for c, t in ACTIVITY_SCHEMA.items()],
        F.lit(1).cast("bigint").alias("n"),
        moment(run_ts).alias("last_update"),
        "item",
    )


def append_inbound(ledger: DataFrame, detail: DataFrame, items: DataFrame, run_ts: datetime) -> DataFrame:
    """Add inbound rows whose (code, location, shipment) the ledger does not have."""
    return ledger.select(*LEDGER_COLUMNS).unionByName(fresh_inbound(ledger, detail, items, run_ts))


def fresh_activity(ledger: DataFrame, consolidated: DataFrame, run_ts: datetime) -> DataFrame:
    """Activity rows that the ledger does not have."""
    key = [*LEDGER_KEY, "flow"]
    fresh = consolidated.join(ledger.select(*key), key, "left_anti")
    return fresh.withColumn("last_update", moment(run_ts)).select(*LEDGER_COLUMNS)


def append_activity(ledger: DataFrame, consolidated: DataFrame, run_ts: datetime) -> DataFrame:
    """Add activity rows that the ledger does not have; rows it has are never corrected. So a window may
    overlap the one before."""
    return ledger.select(*LEDGER_COLUMNS).unionByName(fresh_activity(ledger, consolidated, run_ts))
