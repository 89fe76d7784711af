"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled by a hash. A document's virtual finish time is the cumulative size of its source up
to it, divided by the source's target; a second and third turn through a source carry on counting. All copies are sorted by
finish time over the whole table and taken until the budget, the total size, is spent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfbook.session import durable

TURNS = 3  # most copies of a document
LISTED = 100_000  # most sources whose cuts are broadcast, below 200 bytes each


def words(text: Column) -> Column:
    """The runs of bytes other than ASCII white space; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t-\r]+"), lambda w: w != "")


def running(rows: DataFrame, order: Sequence[Column], sums: dict[str, Column]) -> DataFrame:
    """``rows`` with sums over all rows before each one, in one order over the whole table.

    Range-sorted pieces, written so that the split holds; each adds up on its own, and one total per piece is carried.
    """
    pieces = durable(rows.repartitionByRange(*order).withColumn("__piece", F.spark_partition_id()))
    before = Window.orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)  # one row per piece
    totals = pieces.groupBy("__piece").agg(*[F.sum(c).alias(f"__{n}") for n, c in sums.items()])
    carried = totals.select("__piece", *[F.coalesce(F.sum(f"__{n}").over(before), F.lit(0)).alias(f"__{n}") for n in sums])
    own = Window.partitionBy("__piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = pieces.select("*", *[F.coalesce(F.sum(c).over(own), F.lit(0)).alias(n) for n, c in sums.items()])
    return local.join(F.broadcast(carried), "__piece").select(*rows.columns, *[(F.col(n) + F.col(f"__{n}")).alias(n) for n in sums])


def targets(sizes: DataFrame, weights: Sequence[int]) -> DataFrame:
    """(__source, source_size) -> the same with ``target``: shares of the total by weight, at most TURNS times the size.

    Sources take the weights in turn by code point, null last. With sources in order of size per weight, those that reach
    their cap come first, and the rest share what these leave: the level is the first that its own source stays above.
    """
    placed = running(sizes, [F.col("__source")], {"at": F.lit(1)})
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("at") % len(weights) + 1).cast("int"))
    capped = placed.select("__source", "source_size", weight.alias("weight"), (F.col("source_size") * TURNS).alias("cap"))
    capped = capped.withColumn("rate", F.col("cap") / F.col("weight"))
    filled = running(capped, [F.col("rate"), F.col("__source")], {"spent": F.col("cap"), "passed": F.col("weight")})
    total, weighed = capped.agg(F.sum("source_size"), F.sum("weight")).first()
    level = ((F.lit(total) - F.col("spent")) / (F.lit(weighed) - F.col("passed"))).cast("double")
    first = filled.withColumn("level", level).filter("rate > level").agg(F.min(F.struct("rate", "__source", "level"))["level"]).first()[0]
    return capped.select("__source", "source_size", F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(first or 0.0)).alias("target"))


def _named(docs: DataFrame, seed: str) -> list[Column]:
    """Source, and the place in its shuffled order: hash of doc_id (of the text, where there is none), doc_id, hash of the text."""
    text = F.xxhash64(F.col("text").cast("string"))
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat_ws(":", F.lit("none"), text))
    place = F.struct(F.md5(F.concat_ws(":", F.lit(seed), name)).alias("key"), F.col("doc_id").cast("long").alias("id"), text.alias("text_hash"))
    # null last, and no null among the keys
    source = F.struct(F.col("source").isNull().alias("missing"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("name"))
    return [source.alias("__source"), place.alias("__place")]


def _numbered(docs: DataFrame, weights: Sequence[int], seed: str) -> DataFrame:
    """(__source, __place, size, source_size, target, cuts): of each row, without its texts.

    ``cuts`` holds, for each turn, the last place of the source that the turn takes. Finish times rise with the place, so
    a turn takes all places up to one.
    """
    rows = durable(docs.select(*_named(docs, seed), F.size(words(F.col("text").cast("string"))).cast("long").alias("size")))
    sizes = rows.groupBy("__source").agg(F.sum("size").alias("source_size"))
    summed = durable(running(rows, [F.col("__source"), F.col("__place")], {"before": F.col("size")}))
    starts = summed.groupBy("__source").agg(F.min("before").alias("start"))
    aims = durable(targets(sizes, weights).join(starts, "__source"))
    numbered = summed.join(aims, "__source").withColumn("upto", F.col("before") - F.col("start") + F.col("size"))
    finish = lambda turn: F.coalesce((F.col("upto") + F.col("source_size") * turn) / F.nullif("target", F.lit(0.0)), F.lit(0.0))
    order = lambda turn: F.struct(finish(turn).alias("finish"), F.col("__place").alias("place"), turn.cast("int").alias("turn"))
    turns = numbered.select("__place", "size", "upto", "source_size", "target", F.explode(F.sequence(F.lit(0), F.lit(TURNS - 1))).alias("t"))
    queue = running(turns.select(order(F.col("t")).alias("order"), "size"), [F.col("order")], {"spent": F.col("size")})
    budget = rows.agg(F.sum("size")).first()[0] or 0
    end = queue.filter(F.col("spent") + F.col("size") > budget).agg(F.min("order").alias("end"))  # one row, null if all are taken
    taken = lambda t: F.col("end").isNull() | (order(F.lit(t)) < F.col("end"))
    cuts = numbered.join(F.broadcast(end)).groupBy("__source").agg(
        F.array(*[F.max(F.when(taken(t), F.col("__place"))) for t in range(TURNS)]).alias("cuts")
    )
    return summed.join(aims.join(cuts, "__source"), "__source").select("__source", "__place", "size", "source_size", "target", "cuts")


def _copies() -> Column:
    return sum((F.when(F.col("__place") <= F.col("cuts")[t], 1).otherwise(0) for t in range(TURNS)), F.lit(0))


def mix_report(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), seed: str = "mix") -> DataFrame:
    """(doc_id, size, source_size, target, taken) per row; taken counts the words of all copies, 0 to 3 times the size.

    Size is the number of words; null text has size 0 and is taken as its place in the order falls. A null source is a source of its
    own, after all others. Rows without doc_id are ordered by a hash of their text, rows that repeat one by that hash, too; rows equal
    in both are taken alike. Reruns agree, because the order depends on nothing but doc_id and text. No rows for no rows.
    """
    numbered = _numbered(docs.select("doc_id", "source", "text"), weights, seed)
    taken = (F.col("size") * _copies()).cast("long").alias("taken")
    return numbered.select(F.col("__place.id").alias("doc_id"), "size", "source_size", "target", taken)


def mixed(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), seed: str = "mix") -> DataFrame:
    """The mix itself: each row of ``docs`` as many times as it is taken. Texts stay where they are read."""
    numbered = _numbered(docs.select("doc_id", "source", "text"), weights, seed)
    cuts = durable(numbered.select("__source", "cuts").distinct())
    if cuts.count() <= LISTED:
        cuts = F.broadcast(cuts)
    rows = docs.select(F.struct("*").alias("__row"), *_named(docs, seed)).join(cuts, "__source").withColumn("copies", _copies()).filter("copies > 0")
    return rows.select("__row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("__row.*")
