"""The item catalogue: which stock codes are followed, and under which item (A1-A10)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfbook.config import ExcludeRule, ItemRule
from shelfbook.functions.clock import moment
from shelfbook.functions.text import alias_key
from shelfbook.operators.lookup import lookup_join
from shelfbook.session import durable

ITEM_FIELDS = ("item", "rpt_it", "ri_vendor_id", "ri_section", "ic_cost", "ri_isbn", "ri_upc")


def excluded_items(product_master: DataFrame, base_inventory: DataFrame, rule: ExcludeRule) -> DataFrame:
    """Codes left out. An unknown vendor makes the keep-lists unknown, and the code is not left out."""
    based = base_inventory.select("item_code", F.lit(True).alias("based")).distinct()
    pm = lookup_join(product_master, based, ["item_code"], "left")
    listed = (
        F.col("item_code").isin(*rule.codes)
        | F.col("based").isNotNull()
        | F.col("product_type").isin(*rule.product_types)
        | (F.col("user_char15") == rule.tag)
        | (F.col("purchase_from_vendor_id") == rule.purchase_vendor)
    )
    kept = F.trim("purchase_from_vendor_id").isin(*rule.kept_purchase_vendors) | F.trim("vendor_id").isin(
        *rule.kept_vendors
    )
    return pm.filter(listed & ~kept).select("item_code").distinct()


def select_items(
    product_master: DataFrame,
    excluded: DataFrame,
    rule: ItemRule,
    as_of: datetime,
    elsewhere: DataFrame | None = None,
) -> DataFrame:
    """Codes that the rule admits and that are neither excluded nor followed ``elsewhere``."""
    tests: list[Column] = []
    if rule.sections:
        tests.append(F.trim("section_code").isin(*rule.sections))
    if rule.purchase_vendors:
        tests.append(F.col("purchase_from_vendor_id").isin(*rule.purchase_vendors))
    if rule.recent_tag:
        recent = F.col("create_date") > moment(as_of - timedelta(days=rule.recent_days))
        tests.append((F.col("user_char15") == rule.recent_tag) & recent)
    if rule.either_vendors:
        tests.append(F.col("purchase_from_vendor_id").isin(*rule.either_vendors))
        tests.append(F.col("vendor_id").isin(*rule.either_vendors))
    base = product_master.filter(reduce(lambda a, b: a | b, tests)).select(
        "item_code", F.col("purchase_from_vendor_id").alias("pf_vendor")
    )
    for other in (excluded, elsewhere):
        if other is not None:
            base = base.join(other.select("item_code"), "item_code", "left_anti")
    return base


def _all_links(product_master: DataFrame, product_master_dist: DataFrame) -> DataFrame:
    """Every code with its raw report code and the reporting item (itself if the report code is blank)."""
    report = F.col("report_item_code")
    own = report.isNull() | (F.trim(report) == "")
    return product_master.select("item_code").join(
        product_master_dist.select("item_code", "report_item_code"), "item_code"
    ).select("item_code", "report_item_code", F.when(own, F.col("item_code")).otherwise(report).alias("rpt_it"))


def seed_links(
    product_master: DataFrame, product_master_dist: DataFrame, base: DataFrame, excluded: DataFrame
) -> DataFrame:
    """Links whose code or report code is in the base; the either-or is two equi-joins."""
    links = _all_links(product_master, product_master_dist)
    codes = base.select("item_code")
    by_code = links.join(codes, "item_code", "left_semi")
    reporting = links.filter(F.trim("report_item_code") != "")  # a blank matches nothing
    by_report = reporting.join(codes.withColumnRenamed("item_code", "report_item_code"), "report_item_code", "left_semi")
    both = by_code.unionByName(by_report).join(excluded.select("item_code"), "item_code", "left_anti")
    return both.select("item_code", "rpt_it").distinct()


def expand_links(
    links: DataFrame,
    product_master: DataFrame,
    product_master_dist: DataFrame,
    reapply_excluded: DataFrame | None = None,
) -> DataFrame:
    """Three passes, each seeing the one before; deliberately not repeated until nothing changes.

    Codes that are some code's reporting item; codes that report to a known reporting item; codes that
    report to a known code.
    """
    every = _all_links(product_master, product_master_dist)
    for column, known in (("item_code", "rpt_it"), ("report_item_code", "rpt_it"), ("report_item_code", "item_code")):
        links = durable(links)  # read three times by each pass
        reached = links.select(F.col(known).alias(column)).distinct()
        able = every.filter(F.trim(column) != "")
        added = able.join(links.select("item_code"), "item_code", "left_anti").join(reached, column, "left_semi")
        links = links.unionByName(added.select("item_code", "rpt_it").distinct())
    if reapply_excluded is not None:
        links = links.join(reapply_excluded.select("item_code"), "item_code", "left_anti")
    return links


def repair_parent(links: DataFrame) -> DataFrame:
    """Each reporting item is replaced, once and all at the same time, by its own reporting item."""
    parents = links.groupBy(F.col("item_code").alias("rpt_it")).agg(F.min("rpt_it").alias("parent"))
    return lookup_join(links, parents.hint("merge"), ["rpt_it"], "left").select(
        "item_code", F.coalesce("parent", "rpt_it").alias("rpt_it")
    )


def canonical_item(links: DataFrame, product_master: DataFrame) -> DataFrame:
    """The item a code is counted under: the code whose alias holds it, else itself."""
    holders = product_master.select(
        alias_key(F.col("item_alias")).alias("alias_code"), F.col("item_code").alias("holder")
    ).filter(F.col("alias_code").isNotNull())
    return links.join(holders.hint("merge"), links["item_code"] == holders["alias_code"], "left").select(
        "item_code", F.coalesce("holder", "item_code").alias("item"), "rpt_it"
    )


def override_table(spark: SparkSession, overrides: Sequence[tuple]) -> DataFrame:
    """Fold the ordered corrections into one row per code."""
    folded: dict[str, list] = {}
    for codes, item, rpt_it in overrides:
        for code in codes:
            row = folded.setdefault(code, [None, None])
            row[0], row[1] = item or row[0], rpt_it or row[1]
    rows = [(code, *row) for code, row in folded.items()]
    return spark.createDataFrame(rows, "item_code string, new_item string, new_rpt_it string")


def apply_overrides(links: DataFrame, overrides: DataFrame) -> DataFrame:
    return lookup_join(links, overrides, ["item_code"], "left").select(
        "item_code",
        F.coalesce("new_item", "item").alias("item"),
        F.coalesce("new_rpt_it", "rpt_it").alias("rpt_it"),
    )


def enrich_items(links: DataFrame, product_master: DataFrame, product_master_dist: DataFrame) -> DataFrame:
    """Cost from the code itself; vendor, section, ISBN and UPC from its reporting item."""
    own = product_master.select("item_code", F.col("cost").alias("ic_cost"))
    parent = product_master.select(
        F.col("item_code").alias("rpt_it"),
        F.coalesce("purchase_from_vendor_id", "vendor_id").alias("ri_vendor_id"),
        F.trim("section_code").alias("ri_section"),
        F.col("isbn").alias("ri_isbn"),
    )
    upc = product_master_dist.select(F.col("item_code").alias("rpt_it"), F.col("upc").alias("ri_upc"))
    # Tables as long as the links themselves: small on disk, they would still be broadcast when they fill the memory of a task.
    joined = links.join(own.hint("merge"), "item_code").join(parent.hint("merge"), "rpt_it").join(upc.hint("merge"), "rpt_it")
    return joined.select("item_code", *ITEM_FIELDS).distinct()


def upsert_items(
    current: DataFrame, incoming: DataFrame, run_ts: datetime, null_safe: bool = False
) -> DataFrame:
    """The next catalogue: changed rows updated, new rows added, all others kept.

    By default a change from or to an unknown value is not a change, as in plain ``<>``.
    """
    old, new = current.alias("old"), incoming.alias("new")
    both = old.join(new, F.col("old.item_code") == F.col("new.item_code"), "full_outer")

    def differs(name: str) -> Column:
        a, b = F.col(f"old.{name}"), F.col(f"new.{name}")
        return ~a.eqNullSafe(b) if null_safe else F.coalesce(a != b, F.lit(False))

    is_new = F.col("old.item_code").isNull()
    changed = F.col("new.item_code").isNotNull() & reduce(lambda a, b: a | b, [differs(f) for f in ITEM_FIELDS])
    takes_new = is_new | changed
    return both.select(
        F.coalesce("old.item_code", "new.item_code").alias("item_code"),
        *[F.when(takes_new, F.col(f"new.{f}")).otherwise(F.col(f"old.{f}")).alias(f) for f in ITEM_FIELDS],
        F.when(takes_new, moment(run_ts)).otherwise(F.col("old.last_update")).alias("last_update"),
    )
