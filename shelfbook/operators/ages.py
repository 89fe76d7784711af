"""Age of stock on hand and at disposition, first in first out (F1-F16).

Inbound rows are lots. Laid end to end in ledger order, the lots of one (loc, item) cover the unit
positions 1..N; ``start`` is the number of units before a lot. With ``B`` units received before a ledger
row and ``q`` units on the book, first-in-first-out says that the units on hand are the positions above
``floor = B - q`` (kept within 0..B). So every sum over the lots on hand is a difference of two
cumulative sums, one at ``B`` and one at ``floor``, and a median is the lot that holds one position.

A row with no more than ``FEW_LOTS`` lots so far is paired with them, which costs less than asking. A row
with more never is: it asks for a handful of positions, and one ordered pass over lots and questions
answers them. Work grows with rows, not with rows times lots.

Ages count hour boundaries and are kept as day fractions rounded to six decimals, per lot. That rounding
depends only on the hour difference modulo 3, so units are also counted per class of the lot's hour
modulo 3, and the sums of rounded ages come out exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfbook.functions.clock import epoch_hours
from shelfbook.operators import uneven
from shelfbook.operators.adjust import ADJUST_KEY
from shelfbook.operators.lookup import lookup_join
from shelfbook.operators.scan import Measure, scan, windowed
from shelfbook.operators.sequence import RUN, Shape, over_runs

# Name prefix of each variant and the adjustment added to the book quantity.
VARIANTS = (("", None), ("aj_", "adj_q"), ("naj_", "n_adj_q"), ("faj_", "f_adj_q"))
ACTIVITY = ("loc", "item", "item_code", "sku_ext", "u", "xacn", "ts", "flow", "qty")
AGE_TYPE = "decimal(38,12)"
FEW_LOTS = 64  # lots of a row that it may be paired with


def age_columns() -> list[str]:
    per_variant = ("inv_days", "qty_days", "a_inv_age", "m_inv_age", "qty_age")
    return [age_name(measure, prefix) for measure in per_variant for prefix, _ in VARIANTS]


def age_name(measure: str, prefix: str) -> str:
    """``a_inv_age`` + ``aj_`` -> ``a_aj_inv_age``; ``inv_days`` + ``aj_`` -> ``aj_inv_days``."""
    if measure in ("a_inv_age", "m_inv_age"):
        return f"{measure[:2]}{prefix}{measure[2:]}"
    return prefix + measure


def age_micros(hours: str) -> str:
    """Hours as millionths of a day, rounded half up."""
    return f"(({hours}) * 125000 + CASE ({hours}) % 3 WHEN 1 THEN 1 WHEN 2 THEN -1 ELSE 0 END) div 3"


def as_days(micros: str) -> str:
    return f"CAST(CAST({micros} AS DECIMAL(25,0)) * CAST(0.000001 AS DECIMAL(6,6)) AS DECIMAL(38,6))"


def plus(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add columns given as SQL text; long lists of expressions reach Spark in one call."""
    return df.selectExpr("*", *[f"{text} AS {name}" for name, text in columns.items()])


def inbound_lots(ledger: DataFrame, shape: Shape | None = None) -> DataFrame:
    """The inbound rows with their reverse rank ``d_in_u`` (1 = newest)."""
    shape = shape or Shape.of(ledger)
    lots = ledger.filter(F.col("flow") == "in").select(*RUN, "u", "ts", "xacn", "qty")
    counted = [Measure("_lot", "count", F.lit(1)), Measure("_lots", "count", F.lit(1), "all")]
    ranked = over_runs(lots, RUN, counted, shape)
    return ranked.withColumn("d_in_u", F.col("_lots") - F.col("_lot") + 1).drop("_lot", "_lots")


def with_adjustments(rows: DataFrame, adjustments: DataFrame, shape: Shape, how: str = "inner") -> DataFrame:
    """Attach the segment's adjustments to each ledger row."""
    wanted = adjustments.select(*ADJUST_KEY, "adj_q", "n_adj_q", "f_adj_q", F.lit(True).alias("matched"))
    if shape.long_runs is None:
        return rows.join(wanted, list(ADJUST_KEY), how)
    # One segment may hold most of a long run: join piece by piece, each segment repeated only for the
    # pieces that it really touches.
    pieces = rows.withColumn("_piece", shape.piece())
    touched = pieces.select(*ADJUST_KEY, "_piece").distinct()
    key = [*ADJUST_KEY, "_piece"]
    return pieces.join(touched.join(wanted, list(ADJUST_KEY)).repartition(*key), key, how).drop("_piece")


def lot_positions(ledger: DataFrame, shape: Shape) -> DataFrame:
    """Ledger rows with the cumulative inbound figures before each row."""
    is_in = F.col("flow") == "in"
    units = F.when(is_in, F.col("qty"))
    rows = ledger.withColumn("hour", epoch_hours(F.col("ts")))
    hour = F.col("hour")
    measures = [
        Measure("b_units", "sum", units, "before"),
        Measure("b_hours", "sum", units * hour, "before"),
        Measure("b_class0", "sum", F.when(hour % 3 == 0, units), "before"),
        Measure("b_class1", "sum", F.when(hour % 3 == 1, units), "before"),
        Measure("lots", "count", F.when(is_in, 1)),
        Measure("counted_lots", "count", units),
        Measure("undated_lots", "count", F.when(is_in & hour.isNull(), 1)),
    ]
    if shape.negative_lots:
        measures.append(Measure("negative_lots", "count", F.when(units < 0, 1)))
    placed = over_runs(rows, RUN, measures, shape)
    if not shape.negative_lots:
        placed = placed.withColumn("negative_lots", F.lit(0).cast("bigint"))
    sums = ("b_units", "b_hours", "b_class0", "b_class1")
    return placed.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in sums})


def quantities() -> dict[str, str]:
    """Quantity on the book before and after the activity, per variant."""
    result = {}
    for prefix, adjustment in VARIANTS:
        shift = f" + {adjustment}" if adjustment else ""
        result[f"{prefix}before"] = f"inv_q - coalesce(qty, 0){shift}"
        result[f"{prefix}after"] = f"inv_q{shift}"
    return result


def _asked(rows: DataFrame) -> DataFrame:
    """Per variant the floors and median places, and the distinct positions to look up."""
    book = quantities()
    on_book, floors, places = {}, {}, {}
    for prefix, _ in VARIANTS:
        # An inbound row with a known quantity always leaves its own lot at zero, so its sums exist
        # even where the book quantity is unknown.
        own = "CASE WHEN flow = 'in' AND qty IS NOT NULL THEN 0 END"
        before, floor = f"{prefix}before", f"{prefix}before_floor"
        on_book[before] = f"coalesce({book[before]}, {own})"
        on_book[f"{prefix}after"] = f"CASE WHEN flow = 'out' THEN {book[f'{prefix}after']} END"
        for moment in (before, f"{prefix}after"):
            floors[f"{moment}_floor"] = (
                f"CASE WHEN {moment} IS NOT NULL THEN least(greatest(b_units - {moment}, 0), b_units) END"
            )
        low = f"{floor} + ({before} + 1) div 2"
        high = f"{floor} + {before} div 2 + 1"  # the same place for an odd quantity
        places[f"{prefix}median_low"] = f"CASE WHEN {floor} < b_units AND {low} <= b_units THEN {low} END"
        places[f"{prefix}median_high"] = f"CASE WHEN {floor} < b_units AND {high} <= b_units THEN {high} END"
    rows = plus(plus(plus(rows, on_book), floors), places)
    inside = [f"CASE WHEN {floor} > 0 AND {floor} < b_units THEN {floor} + 1 END" for floor in floors]
    return plus(rows, {"asked": f"array_distinct(array_compact(array({', '.join([*inside, *places])})))"})


LOT = ("b_units", "hour", "b_hours", "b_class0", "b_class1")
ASKED = ("before_floor", "after_floor", "median_low", "median_high")


def answer_positions(rows: DataFrame, shape: Shape) -> DataFrame:
    """Adds ``found``: for each asked position the lot that holds it.

    Each ledger row turns into one carrier of its own columns, one row per asked position and, if it is a
    lot, one row at its start. In position order the latest lot before a question is its answer; carrier
    and answers then meet again on (loc, item, u).
    """
    answers = F.col("matched") & (F.col("lots") > 0) & (F.col("negative_lots") == 0)
    is_lot = (F.col("flow") == "in") & (F.col("qty") > 0) & (F.col("negative_lots") == 0)
    event = lambda place, kind: F.struct(place.cast("bigint").alias("place"), F.lit(kind).alias("kind"))
    none = F.array().cast("array<struct<place:bigint,kind:int>>")
    events = F.concat(
        F.when(answers, F.array(event(F.lit(None), 0))).otherwise(none),
        F.when(answers, F.transform("asked", lambda p: event(p, 1))).otherwise(none),
        F.when(is_lot, F.array(event(F.col("b_units"), 2))).otherwise(none),
    )
    asked = [f"{p}{name}" for p, _ in VARIANTS for name in ASKED]
    carried = [*(c for c in ACTIVITY if c not in (*RUN, "u")), *LOT, "counted_lots", *asked]
    spread = rows.select("*", F.explode(events).alias("event"))
    kind = F.col("event.kind")
    spread = spread.select(
        *RUN,
        "u",
        F.col("event.place").alias("place"),
        kind.alias("kind"),
        F.when(kind == 0, F.struct(*carried)).alias("row"),
        F.when(kind == 2, F.struct(*LOT)).alias("lot"),
    )
    holder = Measure("holder", "last", F.col("lot"))
    order = [("place", "asc"), ("kind", "asc")]
    held = scan(spread, RUN, order, [holder], shape.long_runs, tie=["u"]).filter(F.col("kind") < 2)
    met = held.groupBy(*RUN, "u").agg(
        F.first("row", ignorenulls=True).alias("row"),
        F.map_from_entries(F.collect_list(F.when(F.col("kind") == 1, F.struct("place", "holder")))).alias("found"),
    )
    return met.select(*RUN, "u", "row.*", "found")


def _weigh(floor: str) -> tuple[dict[str, str], dict[str, str], dict[str, str]]:
    """Unit-hours above a floor, and by how many thirds of a millionth the rounded ages differ."""
    lot = f"{floor}_lot"
    part = f"({floor} - {lot}.b_units)"
    inside = {
        "b_hours": f"{lot}.b_hours + {part} * {lot}.hour",
        "b_class0": f"{lot}.b_class0 + CASE WHEN {lot}.hour % 3 = 0 THEN {part} ELSE 0 END",
        "b_class1": f"{lot}.b_class1 + CASE WHEN {lot}.hour % 3 = 1 THEN {part} ELSE 0 END",
    }
    # The first and the last position need no lot.
    above = {
        f"{floor}_{figure}": f"{figure} - CASE WHEN {floor} = 0 THEN 0 WHEN {floor} = b_units THEN {figure} ELSE {value} END"
        for figure, value in inside.items()
    }
    class0, class1 = f"{floor}_b_class0", f"{floor}_b_class1"
    units = f"(b_units - {floor})"
    class2 = f"({units} - {class0} - {class1})"
    weighed = {
        f"{floor}_hours": f"hour * {units} - {floor}_b_hours",
        f"{floor}_rounding": f"CASE hour % 3 WHEN 0 THEN {class2} - {class1} WHEN 1 THEN {class0} - {class2} "
        f"ELSE {class1} - {class0} END",
    }
    return {lot: f"try_element_at(found, {floor} + 1)"}, above, weighed


def days_of(units: str) -> str:
    """Sum of the rounded ages, in days, of some units (those above a floor) from their hours and their rounding."""
    part = as_days(f"(({units}_hours % 24) * 125000 + {units}_rounding) div 3")
    return f"CAST(CAST({units}_hours div 24 AS DECIMAL(25,0)) + {part} AS DECIMAL(38,6))"


def _mean(days: str, units: str) -> str:
    return f"{days} / CAST(nullif({units}, 0) AS DECIMAL(19,0))"


def stored_ages(prefix: str, units: str) -> dict[str, str]:
    """The five stored figures of a variant from its days on hand, days moved and median sum."""
    on_hand, moved = f"{prefix}on_hand", f"{prefix}moved"
    stored = {
        "inv_days": on_hand,
        "a_inv_age": _mean(on_hand, units),
        # Half of a sum of two ages keeps a seventh decimal.
        "m_inv_age": f"CAST({prefix}middle * 5 AS DECIMAL(25,0)) * CAST(0.0000001 AS DECIMAL(7,7))",
        "qty_age": _mean(moved, "abs(qty)"),
    }
    figures = {age_name(name, prefix): f"CAST({text} AS {AGE_TYPE})" for name, text in stored.items()}
    return figures | {age_name("qty_days", prefix): f"CAST({moved} AS BIGINT)"}


USABLE = "counted_lots > 0 AND NOT (flow = 'in' AND qty IS NULL)"


def ages_from_answers(rows: DataFrame) -> DataFrame:
    """Age columns of every answered ledger row.

    One variant after the other, each in short steps: Spark compiles every step to a method of its own,
    and the JVM only optimises short methods.
    """
    for prefix, _ in VARIANTS:
        before, after = f"{prefix}before_floor", f"{prefix}after_floor"
        kept = [c for c in rows.columns if c not in [f"{prefix}{name}" for name in ASKED]]
        steps = [b | a for b, a in zip(_weigh(before), _weigh(after))]
        ends = {f"{prefix}{end}": f"hour - try_element_at(found, {prefix}median_{end}).hour" for end in ("low", "high")}
        steps[0] |= ends
        low, high = (age_micros(name) for name in ends)
        steps.append(
            {
                f"{prefix}on_hand": f"CASE WHEN {USABLE} THEN {days_of(before)} END",
                f"{prefix}left": f"CASE WHEN flow = 'out' THEN {days_of(after)} END",
                f"{prefix}middle": f"CASE WHEN {USABLE} THEN {low} + {high} END",
            }
        )
        moved = f"CASE WHEN flow = 'out' THEN {prefix}on_hand - {prefix}left ELSE 0 END"
        steps.append({f"{prefix}moved": f"CAST({moved} AS DECIMAL(38,6))"})
        for step in steps:
            rows = plus(rows, step)
        figures = stored_ages(prefix, f"b_units - {before}")
        rows = rows.selectExpr(*kept, *[f"{text} AS {name}" for name, text in figures.items()])
    return rows.select(*ACTIVITY, *age_columns())


def middle_needs(on_book: str) -> dict[str, str]:
    """Units from the oldest one on at which the lower and the upper half of the book are reached."""
    return {
        "low": f"(CASE WHEN {on_book} % 2 = 0 THEN {on_book} ELSE {on_book} + 1 END) div 2",
        "high": f"CASE WHEN {on_book} % 2 = 0 THEN {on_book} div 2 + 1 ELSE ({on_book} + 1) div 2 END",
    }


def left_of_lot(on_book: str) -> str:
    """Units of lot x left with ``on_book`` units on the book."""
    floor = f"(b_units - {on_book})"
    return (
        f"CASE WHEN x.lot_u > u OR {on_book} IS NULL OR x.b_units = b_units THEN 0L "
        f"WHEN x.b_units >= {floor} THEN x.qty ELSE greatest(x.b_units + x.qty - {floor}, 0L) END"
    )


def paired_ages(asked: DataFrame, rows: DataFrame) -> DataFrame:
    """Age columns of ``asked`` rows from the pairs of each with its lots. Lots may be negative here."""
    book = quantities()
    lots = rows.filter((F.col("flow") == "in") & F.col("qty").isNotNull() & (F.col("lots") <= FEW_LOTS)).select(
        *RUN, F.struct(F.col("u").alias("lot_u"), "b_units", "qty", F.col("hour").alias("lot_hour")).alias("x")
    )
    place = (*RUN, "u")
    shown = F.struct(*[c for c in ACTIVITY if c not in place], "counted_lots").alias("row")
    questions = plus(asked, book).select(*place, "hour", "b_units", "flow", *book, shown).alias("q")
    met = [F.col(f"q.{c}") == F.col(f"l.{c}") for c in RUN] + [F.col("l.x.lot_u") <= F.col("q.u")]
    pairs = questions.join(lots.alias("l"), reduce(Column.__and__, met), "left").select("q.*", "l.x")
    left = {}
    for p, _ in VARIANTS:
        left[f"{p}left"] = left_of_lot(f"{p}before")
        left[f"{p}left_after"] = f"CASE WHEN flow = 'out' THEN {left_of_lot(f'{p}after')} END"
    before = [f"{p}before" for p, _ in VARIANTS]
    pairs = plus(pairs, left | {"age": "hour - x.lot_hour", "lot_u": "x.lot_u"}).select(*place, "lot_u", "age", *before, *left, "row")
    running = [Measure(f"{p}running", "sum", F.col(f"{p}left")) for p, _ in VARIANTS]
    pairs = windowed(pairs, place, [("lot_u", "asc")], running)
    sums = {"row": "first(row)"}
    for p, _ in VARIANTS:
        sums[f"{p}units"] = f"sum({p}left)"
        for name in (f"{p}left", f"{p}left_after"):
            sums[f"{name}_hours"] = f"sum({name} * age)"
            sums[f"{name}_rounding"] = f"sum({name} * CASE age % 3 WHEN 1 THEN 1 WHEN 2 THEN -1 ELSE 0 END)"
        for end, need in middle_needs(f"{p}before").items():
            sums[f"{p}{end}"] = f"max(CASE WHEN {p}left <> 0 AND {p}running >= {need} THEN age END)"
    summed = pairs.groupBy(*place).agg(*[F.expr(text).alias(name) for name, text in sums.items()])
    return _paired_figures(summed.select(*place, "row.*", *[name for name in sums if name != "row"]))


def _paired_figures(rows: DataFrame) -> DataFrame:
    """Age columns from the sums over pairs, one variant after the other as in ``ages_from_answers``."""
    for p, _ in VARIANTS:
        own = [f"{p}{name}" for name in ("units", "left_hours", "left_rounding", "left_after_hours", "left_after_rounding", "low", "high")]
        kept = [c for c in rows.columns if c not in own]
        low, high = age_micros(f"{p}low"), age_micros(f"{p}high")
        rows = plus(
            rows,
            {
                f"{p}on_hand": f"CASE WHEN {USABLE} THEN {days_of(f'{p}left')} END",
                f"{p}gone": f"CASE WHEN flow = 'out' THEN {days_of(f'{p}left_after')} END",
                f"{p}middle": f"CASE WHEN {USABLE} THEN {low} + {high} END",
            },
        )
        moved = f"CASE WHEN flow = 'out' THEN {p}on_hand - {p}gone ELSE 0 END"
        rows = plus(rows, {f"{p}moved": f"CAST({moved} AS DECIMAL(38,6))"})
        rows = rows.selectExpr(*kept, *[f"{text} AS {name}" for name, text in stored_ages(p, f"{p}units").items()])
    return rows.select(*ACTIVITY, *age_columns())


def ages(
    ledger: DataFrame,
    adjustments: DataFrame,
    shape: Shape | None = None,
    chosen: DataFrame | None = None,
) -> DataFrame:
    """One row per ledger row with adjustments and at least one lot so far, in four stock variants.

    ``chosen`` (loc, item, u) limits the answer to some ledger rows.
    """
    shape = shape or Shape.of(ledger)
    rows = with_adjustments(lot_positions(ledger, shape), adjustments, shape, how="left")
    if chosen is not None:
        wanted = chosen.select(*RUN, "u", F.lit(True).alias("_chosen"))
        rows = rows.join(wanted, [*RUN, "u"], "left")
        rows = rows.withColumn("matched", F.col("matched") & F.col("_chosen")).drop("_chosen")
    needed = [
        *ACTIVITY, "inv_q", "adj_q", "n_adj_q", "f_adj_q", "matched", "hour", "b_units", "b_hours",
        "b_class0", "b_class1", "lots", "counted_lots", "negative_lots", "undated_lots",
    ]
    rows = shape.store(rows.select(*needed))  # read by questions and by lots
    asked = F.coalesce(F.col("matched") & (F.col("lots") > 0), F.lit(False))
    few = (F.col("lots") <= FEW_LOTS) & (F.col("undated_lots") == 0) & F.col("hour").isNotNull()
    uneven_row = F.col("negative_lots") > 0
    rest = rows.filter(asked & ~few)
    some_even, some_uneven = rest.agg(F.count_if(~uneven_row), F.count_if(uneven_row)).first()
    result = paired_ages(rows.filter(asked & few), rows)
    if some_even:
        others = lookup_join(rows, rest.select(*RUN).distinct(), RUN, "left_semi")
        others = others.withColumn("matched", F.col("matched") & ~few)
        result = result.unionByName(ages_from_answers(answer_positions(_asked(others), shape)))
    if some_uneven:
        result = result.unionByName(uneven.ages_with_negative_lots(rest.filter(uneven_row), rows))
    return result
