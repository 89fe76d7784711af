"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfbook.session import durable

LOCAL = 500_000  # so many links, of 16 bytes, are joined up in one task


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    up: dict[int, int] = {}

    def find(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = up[x]
        return x

    for batch in batches:
        for v, u in zip(*(c.to_pylist() for c in batch.columns)):
            a, b = sorted((find(v), find(u)))
            up[b] = a
    ids = list(up)
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([find(x) for x in ids], pa.int64())], ["id", "component"])


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``links`` (a, b) -> (id, component): every id that has a link, with the smallest id reachable.

    Large and small star steps in turn, until each id hangs on one other and none of those hangs on a further one: each
    step groups the neighbours of an id and hangs them on the smallest one. Only minima are grouped, combined before the
    shuffle; the join that deals them out is an ordinary one, which AQE splits for an id with very many links. Rounds grow
    with the logarithm of the longest path. Each round is a written table, so a lost executor repeats no earlier round.

    Few links, up to LOCAL of them, are joined up in one task instead, with the same result.

    ``known`` is the result for earlier links. The new ones are then taken as links between its components, so that
    the rounds see no earlier link again, and the result covers both.
    """
    ends = links.select("a", "b")
    if known is not None:
        for end in ("a", "b"):
            to = known.select(F.col("id").alias(end), F.col("component").alias("to"))
            ends = ends.join(to, end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
    edges = durable(ends.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).filter("v <> u").distinct())
    few = edges.count() <= LOCAL
    while not few:
        both = edges.select("u", "v").union(edges.select("v", "u"))
        near = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        if not near.filter("m < u and n > 1").count():
            break
        least = near.select("u", F.least("u", "m").alias("m"))
        large = edges.join(least, "u").select("v", "m")  # v > u, so v hangs on what u sees
        small = large.groupBy("v").agg(F.min("m").alias("least"))
        moved = large.join(small, "v")
        edges = durable(
            moved.select("v", F.col("least").alias("u"))
            .union(moved.filter("m <> least").select(F.col("m").alias("v"), F.col("least").alias("u")))
            .distinct()
        )
    if few:
        found = durable(edges.select("v", "u").coalesce(1).mapInArrow(_joined, "id long, component long"))
    else:
        found = edges.select(F.col("v").alias("id"), F.col("u").alias("component")).union(
            edges.select(F.col("u").alias("id"), F.col("u").alias("component")).distinct()
        )
    if known is None:
        return found
    carried = known.join(found.toDF("component", "to"), "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    return durable(carried.union(found.join(known.select("id"), "id", "left_anti")))
