"""Ages where an inbound quantity is negative.

Then cumulative units no longer grow with every lot, and the units on hand are not one stretch of
positions. The rule is applied lot by lot for the ledger rows after a negative lot, and only those. Rows
with few lots so far are paired with them. The others meet their lots in blocks of bounded size, each
block giving one partial result, so no task holds a whole run and no long list of row-lot pairs is
written out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfbook.operators import ages as even
from shelfbook.operators.lookup import lookup_join
from shelfbook.operators.sequence import RUN

BLOCK_LOTS = 512
PLACE = (*RUN, "u")
QUESTION = (*RUN, "u", "variant")


def _blocks(rows: DataFrame) -> DataFrame:
    lots = rows.filter((F.col("flow") == "in") & F.col("qty").isNotNull())
    affected = lots.filter(F.col("qty") < 0).select(*RUN).distinct()
    lots = lots.join(affected, list(RUN), "left_semi")
    lot = F.struct(F.col("u").alias("lot_u"), "b_units", "qty", F.col("hour").alias("lot_hour"))
    return lots.groupBy(*RUN, F.floor((F.col("lots") - 1) / BLOCK_LOTS).alias("block")).agg(
        F.array_sort(F.collect_list(lot)).alias("block_lots"), F.min("u").alias("first_u")
    )


def _oldest(need: str) -> str:
    """Age of the oldest lot of the block at which the running units reach ``need``."""
    left = even.left_of_lot("on_before")
    reached = f"{left} <> 0 AND a.running + {left} >= {need}"
    age = even.age_micros("hour - x.lot_hour")
    return (
        "aggregate(block_lots, named_struct('running', units_before, 'age', CAST(NULL AS BIGINT)), "
        f"(a, x) -> named_struct('running', a.running + {left}, 'age', "
        f"CASE WHEN {reached} THEN greatest(a.age, {age}) ELSE a.age END), a -> a.age)"
    )


def ages_with_negative_lots(asked: DataFrame, rows: DataFrame) -> DataFrame:
    book = even.quantities()
    variants = ", ".join(
        f"named_struct('variant', '{p}', 'on_before', {book[f'{p}before']}, 'on_after', {book[f'{p}after']})"
        for p, _ in even.VARIANTS
    )
    wide = even.plus(asked, {"per_variant": f"array({variants})"})
    questions = wide.select(
        *RUN, "u", "hour", "b_units", "flow", F.explode("per_variant").alias("v")
    ).select(*RUN, "u", "hour", "b_units", "flow", "v.*")
    met = lookup_join(questions, _blocks(rows), RUN).filter(F.col("first_u") <= F.col("u"))
    age = even.age_micros("hour - x.lot_hour")
    summed = lambda term: f"aggregate(block_lots, 0L, (a, x) -> a + {term})"
    # Ages times units may leave 64 bits.
    product = lambda left: f"CAST(({age}) AS DECIMAL(19,0)) * CAST({left} AS DECIMAL(19,0))"
    weighed = lambda left: (
        f"aggregate(block_lots, CAST(0 AS DECIMAL(38,0)), (a, x) -> CAST(a + {product(left)} AS DECIMAL(38,0)))"
    )
    met = even.plus(
        met,
        {
            "units": summed(even.left_of_lot("on_before")),
            "micros": weighed(even.left_of_lot("on_before")),
            "micros_after": f"CASE WHEN flow = 'out' THEN {weighed(even.left_of_lot('on_after'))} END",
        },
    )
    earlier = Window.partitionBy(*QUESTION).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    met = met.withColumn("units_before", F.coalesce(F.sum("units").over(earlier), F.lit(0)).cast("bigint"))
    met = even.plus(met, {end: _oldest(need) for end, need in even.middle_needs("on_before").items()})
    answers = met.groupBy(*QUESTION).agg(
        F.sum("units").alias("units"),
        F.sum("micros").alias("micros"),
        F.sum("micros_after").alias("micros_after"),
        F.max("low").alias("low"),
        F.max("high").alias("high"),
    )
    per_row = answers.groupBy(*RUN, "u").agg(
        F.map_from_entries(
            F.collect_list(F.struct("variant", F.struct("units", "micros", "micros_after", "low", "high")))
        ).alias("answer")
    )
    joined = asked.join(per_row, list(PLACE))
    found, result = {}, {}
    for prefix, _ in even.VARIANTS:
        a = f"answer['{prefix}']"
        found[f"{prefix}on_hand"] = f"CASE WHEN {even.USABLE} THEN {even.as_days(f'{a}.micros')} END"
        found[f"{prefix}units"] = f"{a}.units"
        found[f"{prefix}middle"] = f"CASE WHEN {even.USABLE} THEN {a}.low + {a}.high END"
        found[f"{prefix}moved"] = (
            f"CASE WHEN flow = 'out' THEN {even.as_days(f'{a}.micros - {a}.micros_after')} "
            "ELSE CAST(0 AS DECIMAL(38,6)) END"
        )
        result |= even.stored_ages(prefix, f"{prefix}units")
    return even.plus(joined, found).selectExpr(
        *even.ACTIVITY, *[f"{result[name]} AS {name}" for name in even.age_columns()]
    )
