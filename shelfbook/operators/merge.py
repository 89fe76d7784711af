"""A stored ledger brought up to date only where a load touches it (D1-D5, E, F).

The ledger lies in buckets of whole runs: a run, all rows of one (loc, item), is in one bucket. A load compares its rows with
the narrow key columns of the ledger, which says what it corrects and adds, and from which moment on in which runs. Only
the buckets of these runs are read whole and overwritten. In them, a run is numbered again from a row that nothing
before it depends on: its last inbound row before the first changed moment. That row carries the place, the book quantity
and the count in force; rows before it point no further than to it, so they stay as they are.

Count adjustments and ages follow: a segment that ends before that row is not looked at again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfbook.operators import maintain
from shelfbook.operators.adjust import set_adjustments
from shelfbook.operators.ages import ages
from shelfbook.operators.inbound import DETAIL_KEY, LYING
from shelfbook.operators.lookup import lookup_join
from shelfbook.operators.scan import RUN_LIMIT
from shelfbook.operators.sequence import LEDGER_ORDER, RUN, Shape, mark_segments, sequence_ledger
from shelfbook.session import durable

EARLIEST = datetime(1, 1, 1)  # stands for an unknown moment, which comes first


def at(ts: Column) -> Column:
    return F.coalesce(ts, F.lit(EARLIEST).cast("timestamp_ntz"))


@dataclass(frozen=True)
class LedgerStore:
    """A ledger in ``buckets`` Parquet partitions under ``folder``. ``per_file`` rows of one run go to one file at most."""

    spark: SparkSession
    folder: str
    buckets: int = 64
    per_file: int = RUN_LIMIT

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*RUN), F.lit(self.buckets)).cast("int")

    def read(self) -> DataFrame:
        """The ledger with its column ``bucket``; a filter on that reads only those partitions."""
        return self.spark.read.parquet(self.folder)

    def write(self, rows: DataFrame) -> None:
        """Overwrites the buckets that ``rows`` hold, each with all of its rows, and no other bucket.

        ``rows`` must not be read from the store itself. A long run is spread over several files.
        """
        placed = rows.withColumn("bucket", self.bucket())
        spread = placed.repartition("bucket", F.floor(F.col("u") / self.per_file)).sortWithinPartitions("bucket", *RUN, "u")
        spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.folder)


@dataclass(frozen=True)
class Merged:
    """What a load did: ``runs`` (loc, item, first, from_u, cr_set) that were numbered again from place ``from_u`` on, with the
    count in force there, and the buckets that were written."""

    runs: DataFrame
    buckets: list[int]


def met_news(ledger: DataFrame, detail: DataFrame) -> DataFrame:
    """The stored inbound rows, by (loc, item, item_code, shpmt), with their ``news`` in ``detail``, where one differs or a key
    has several: only these can change a row or its number. ``copy`` numbers the news of a key.
    """
    same = Window.partitionBy(*LYING)
    news = maintain.news_of(detail).select(
        "*", F.count(F.lit(1)).over(same).alias("copies"), F.row_number().over(same.orderBy(LYING[-1])).alias("copy")
    )
    stored = ledger.filter(F.col("shpmt") != "na").select(*DETAIL_KEY, "item", *maintain.SYNCED)
    differs = maintain.differing()
    met = stored.join(news, list(LYING)).withColumn("differs", differs).filter(F.col("differs") | (F.col("copies") > 1))
    new = [f"new_{f}" for f in maintain.SYNCED]
    return met.select(*RUN, "item_code", "shpmt", *new, "copy", "differs", F.least(at(F.col("ts")), at(F.col("new_ts"))).alias("first"))


def corrected_rows(ledger: DataFrame, detail: DataFrame) -> DataFrame:
    """(loc, item, first) of the stored inbound rows that differ from ``detail``; ``first`` is the earlier of old and new moment."""
    return met_news(ledger, detail).filter("differs").select(*RUN, "first")


def resequence(
    rows: DataFrame, touched: DataFrame, limit: int = RUN_LIMIT, keep: Callable[[DataFrame], DataFrame] = durable
) -> tuple[DataFrame, DataFrame]:
    """``rows`` with the runs of ``touched`` (loc, item, first) in order again, and (loc, item, from_u, cr_set) of these.

    Rows from ``first`` on may be new, changed or moved. All others keep u, inv_q, cr_set and nx_in of the stored ledger.
    ``keep`` stages what several steps read; where both tables lie by run, ``Shape.store`` keeps it that way.
    """
    met = lookup_join(rows, touched.select(*RUN, "first"), RUN, "left")
    before = F.col("first").isNotNull() & (at(F.col("ts")) < F.col("first"))
    before_row = F.struct("u", (F.col("inv_q") - F.coalesce("qty", F.lit(0))).alias("book"), F.col("cr_set").alias("count"))
    anchors = met.filter(before & (F.col("flow") == "in")).groupBy(*RUN).agg(F.max(before_row).alias("anchor"))
    state = touched.select(*RUN, "first").join(anchors, list(RUN), "left")
    state = keep(state.select(*RUN, "first", F.coalesce("anchor.u", F.lit(1)).cast("bigint").alias("from_u"), F.col("anchor.book").alias("book"), F.col("anchor.count").alias("count")))

    met = lookup_join(rows, state, RUN, "left")
    again = F.col("first").isNotNull() & ((at(F.col("ts")) >= F.col("first")) | (F.col("u") >= F.col("from_u")))
    carried = ("first", "from_u", "book", "count")
    kept = met.filter(~again).drop(*carried)
    part = keep(met.filter(again).drop("u", "inv_q", "cr_set", "nx_in"))
    shape = Shape.of(part, limit)
    placed = sequence_ledger(part, shape).withColumns(
        {
            "u": F.col("u") + F.col("from_u") - 1,
            "inv_q": F.coalesce(F.col("inv_q") + F.coalesce("book", F.lit(0)), F.col("book")).cast("bigint"),
        }
    )
    marked = mark_segments(placed, shape, LEDGER_ORDER).withColumn("cr_set", F.greatest("cr_set", F.coalesce("count", F.lit(1))).cast("bigint"))
    return kept.unionByName(marked.drop(*carried).select(*kept.columns)), state.select(*RUN, "first", "from_u", F.coalesce("count", F.lit(1)).cast("bigint").alias("cr_set"))


def merge_load(
    store: LedgerStore, detail: DataFrame, consolidated: DataFrame, items: DataFrame, run_ts: datetime, limit: int = RUN_LIMIT
) -> Merged:
    """One load into the stored ledger: inbound corrections, new inbound rows, new activity rows, in order and with markers.

    The result is the same as writing the whole ledger anew. Which rows are corrected or new is decided against all stored
    keys, of which only the key columns are read.
    """
    ledger = store.read()
    added = durable(
        maintain.fresh_inbound(ledger, detail, items, run_ts).unionByName(maintain.fresh_activity(ledger, consolidated, run_ts))
    )
    news = durable(met_news(ledger, detail))
    changes = news.filter("differs").select(*RUN, "first").unionByName(added.select(*RUN, at(F.col("ts")).alias("first")))
    per_run = changes.groupBy(*RUN).agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("changed"))
    touched = durable(per_run.withColumn("bucket", store.bucket()))
    buckets = sorted(row[0] for row in touched.select("bucket").distinct().collect())  # at most store.buckets
    if not buckets:
        return Merged(touched.select(*RUN, "first", F.lit(1).cast("bigint").alias("from_u"), F.lit(1).cast("bigint").alias("cr_set")), [])
    old = ledger.filter(F.col("bucket").isin(buckets)).drop("bucket")
    for name in ("u", "inv_q", "cr_set", "nx_in"):
        added = added.withColumn(name, F.lit(None).cast("bigint"))
    longest, held = old.agg(F.max("u"), F.count(F.lit(1))).first()
    most, changed = touched.agg(F.max("changed"), F.sum("changed")).first()
    if (longest or 0) + most <= limit:  # no run can be long: they lie whole in buckets, and are shuffled once for all steps
        shape = Shape(limit=limit, rows=held + changed)
        touched = shape.store(shape.deal(touched.select(*RUN, "first")))
        mark = touched.select(*RUN, F.lit(True).alias("_touched"))
        # Only rows of the touched runs are synced; the others are carried along, as they lie in the same buckets. The order of the
        # first join holds for the second.
        place = [*RUN, "item_code", "shpmt"]
        news = shape.deal(news.select(*place, *[f"new_{f}" for f in maintain.SYNCED], "copy").distinct()).drop("copy")
        synced = maintain.with_news(shape.deal(old), lookup_join(news, touched.select(*RUN), RUN, "left_semi"), place, run_ts)
        synced = lookup_join(synced, mark, RUN, "left").filter(F.col("shpmt").isNotNull() | F.col("_touched").isNull()).drop("_touched")
        rows = shape.store(synced.select(*old.columns).unionByName(shape.deal(added.select(*old.columns))), ["u"])
        checked = lookup_join(rows.select(*RUN, *maintain.LEDGER_KEY[1:], "u"), mark, RUN, "left").filter("_touched OR u IS NULL")
        maintain.assert_unique_in_runs(checked, RUN, maintain.LEDGER_KEY, "ledger")
        again, state = resequence(rows, touched, limit, shape.store)
        # Nothing is read from the store any more; rows of whole runs follow from staged tables, and are written as they come.
        store.write(again)
        return Merged(state, buckets)
    synced = maintain.sync_inbound(lookup_join(old, touched.select(*RUN), RUN, "left_semi"), detail, run_ts)
    rest = lookup_join(old, touched.select(*RUN), RUN, "left_anti")
    rows = durable(synced.unionByName(added.select(*synced.columns)))
    maintain.assert_unique_in_runs(rows, RUN, maintain.LEDGER_KEY, "ledger")
    again, state = resequence(rows, touched, limit)
    store.write(durable(again.unionByName(rest.select(*again.columns))))
    return Merged(state, buckets)


def refresh_adjustments(store: LedgerStore, merged: Merged, adjustments: DataFrame, limit: int = RUN_LIMIT) -> DataFrame:
    """``adjustments`` of the ledger before the load -> those after it.

    Segments from the count in force at ``from_u`` on are worked out again, from their rows alone; a late count that splits a
    segment, or a corrected one that moves, is among them. All other segments are carried over.
    """
    state = merged.runs.select(*RUN, F.col("cr_set").alias("dirty"))
    kept = lookup_join(adjustments, state, RUN, "left").filter("dirty is null or cr_set < dirty").select(*adjustments.columns)
    rows = store.read().filter(F.col("bucket").isin(merged.buckets)).drop("bucket")
    dirty = durable(lookup_join(rows, state, RUN).filter("cr_set >= dirty").drop("dirty"))
    return kept.unionByName(set_adjustments(dirty, Shape.of(dirty, limit)).select(*adjustments.columns))


def refresh_ages(store: LedgerStore, merged: Merged, adjustments: DataFrame, before: DataFrame, limit: int = RUN_LIMIT) -> DataFrame:
    """``before``, the ages of the ledger before the load -> those after it, with the refreshed ``adjustments``.

    A row's age depends on the lots up to it and on its segment, so rows of clean segments keep theirs. Only touched runs are read.
    """
    state = merged.runs.select(*RUN, F.col("cr_set").alias("dirty"))
    rows = store.read().filter(F.col("bucket").isin(merged.buckets)).drop("bucket")
    runs = durable(lookup_join(rows, state, RUN))
    asked = runs.filter("cr_set >= dirty").select(*RUN, "u")
    clean = runs.filter("cr_set < dirty").select(*RUN, "u")
    touched = lookup_join(before, state.select(*RUN), RUN, "left_semi").join(clean, [*RUN, "u"], "left_semi")
    rest = lookup_join(before, state.select(*RUN), RUN, "left_anti")
    own = lookup_join(adjustments, state.select(*RUN), RUN, "left_semi").select(*adjustments.columns)
    ledger = runs.drop("dirty")
    return rest.unionByName(touched).unionByName(ages(ledger, own, Shape.of(ledger, limit), asked).select(*before.columns))
