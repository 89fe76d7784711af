"""Near-duplicate vectors by a robust-pruned flat graph.

Equal vectors become one class. Diverse centres from a bounded sample cut the classes into overlapping shards: every
class joins its nearest few centres, more of them the more there are. Each shard builds a robust-pruned graph over the leaders
of its close vectors (``range_graph``), and the adjacency lists of all shards are united. In each shard a range-expanding greedy
search then runs over the united lists, from the shard's medoids and from each leader's own node. The members of what it reaches
are confirmed by their cosine in double precision, so no link below the threshold is counted.
A shard above the size limit is cut into blocks, and each two blocks make a cell that is treated as a shard, so that
no pair of a large group is left out. ``audit`` measures the recall against brute force.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfbook.llm.graph import components
from shelfbook.llm.range_graph import adjacency, leaders, pruned, radii, reached
from shelfbook.session import durable

CENTRES = 16_384  # at most; they are what the tasks get, with 8 bytes a number
PER_CENTRE = 384  # classes for which a centre is taken, as long as the limit allows
OVERLAP = 4  # nearest centres whose shards a class joins, at least
PER_DOUBLING = 0.75  # of them for each doubling of the centres
CELL = 4096  # most classes in a shard or cell
APART = 0.7  # centres are less similar than this


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of lists of one length, scaled to length one."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = np.asarray(column.flatten(), np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def within(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of ``x`` have a cosine of at least ``threshold`` with which rows of ``y``, in double precision.

    Products in single precision settle all pairs but those closer to the threshold than their rounding error can be.
    """
    rough = (x.shape[1] + 2) * 2.0**-23
    single = y.astype(np.float32)
    near = np.empty((len(x), len(y)), bool)
    for low in range(0, len(x), 512):
        sims = x[low : low + 512].astype(np.float32) @ single.T
        near[low : low + 512] = sims >= threshold
        a, b = np.nonzero(np.abs(sims - threshold) <= rough)
        near[low + a, b] = _cosines(x, y, low + a, b) >= threshold
    return near


def _cosines(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty(len(a))
    for low in range(0, len(a), 1 << 15):
        part = slice(low, low + (1 << 15))
        out[part] = np.einsum("nd,nd->n", x[a[part]], y[b[part]])
    return out


def roots(near: np.ndarray) -> np.ndarray:
    """The first row that links lead to from each row."""
    n = len(near)
    root = np.arange(n)
    seen = ~near.any(axis=1)
    for first in range(n):
        if seen[first]:
            continue
        seen[first] = True
        front = np.array([first])
        while len(front):
            root[front] = first
            reached = near[front].any(axis=0) & ~seen
            seen |= reached
            front = np.flatnonzero(reached)
    return root


def _meet(shards: np.ndarray) -> np.ndarray:
    """Which rows have a shard in common with which; -1 is none."""
    kinds, kind = np.unique(np.sort(shards, axis=1), axis=0, return_inverse=True)
    common = np.zeros((len(kinds), len(kinds)), bool)
    for p in kinds.T:
        for q in kinds.T:
            common |= p[:, None] == np.where(q < 0, -2, q)
    return common[np.ix_(kind.ravel(), kind.ravel())]


def _lists(x: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Edges (from, to) between the leaders among the rows of ``x``."""
    lead = leaders(x)
    own = np.unique(lead)
    near = pruned(x[own], radii(x, lead)[own], threshold)
    a, slot = np.nonzero(near >= 0)
    return own[a], own[near[a, slot]]


def _build(threshold: float):
    def run(cell: pa.Table) -> pa.Table:
        ids = cell["id"].to_numpy()
        order = np.argsort(ids)
        ids = ids[order]
        a, b = _lists(_matrix(cell["vector"])[order], threshold)
        offsets = np.searchsorted(a, np.arange(len(ids) + 1))
        return pa.table({"id": ids, "next": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids[b], pa.int64()))})

    return run


def _edges(cell: pa.Table, order: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The united lists as edges (from, to) between those rows of the cell that they name."""
    lists = cell["next"].combine_chunks().take(pa.array(order))
    to = np.asarray(lists.flatten(), np.int64)
    owner = np.repeat(np.arange(len(ids)), np.diff(np.asarray(lists.offsets, np.int64)))
    at = np.minimum(np.searchsorted(ids, to), len(ids) - 1)
    here = ids[at] == to
    return owner[here], at[here]


def _searched(x: np.ndarray, edges: tuple[np.ndarray, np.ndarray], threshold: float) -> np.ndarray:
    """Which rows are linked, of the pairs that the searches over ``edges`` reach."""
    lead = leaders(x)
    own, group = np.unique(lead, return_inverse=True)
    heads, radius = x[own], radii(x, lead)[own]
    found = reached(heads, radius, adjacency(heads, group[edges[0]], group[edges[1]]), threshold)
    near = np.zeros((len(x), len(x)), bool)
    members = np.argsort(group, kind="stable")
    ends = np.searchsorted(group[members], np.arange(len(own) + 1))
    some = (found.sum(axis=1) > 1) | (np.diff(ends) > 1)
    for k in np.flatnonzero(some):
        rows, partners = members[ends[k] : ends[k + 1]], np.flatnonzero(found[k][group])
        near[np.ix_(rows, partners)] = within(x[rows], x[partners], threshold)
    return near


def _links(threshold: float):
    """Of one cell; one that brings no column ``next`` is searched over its own lists."""

    def run(cell: pa.Table) -> pa.Table:
        ids = cell["id"].to_numpy()
        order = np.argsort(ids)
        ids, x = ids[order], _matrix(cell["vector"])[order]
        weight, repeats, own = (cell[c].to_numpy()[order] for c in ("weight", "repeats", "own"))
        shard, i, j = (cell[c][0].as_py() for c in ("shard", "i", "j"))
        near = _searched(x, _edges(cell, order, ids) if "next" in cell.column_names else _lists(x, threshold), threshold)
        near &= (own == i)[:, None] & (own == j)
        near |= near.T
        np.fill_diagonal(near, False)
        root = ids[roots(near)]
        # a pair belongs to the first of the shards that both are in, and there to the cell of their two blocks
        some = np.flatnonzero(near.any(axis=1))
        near = near[np.ix_(some, some)]
        if len(some):
            shards = np.asarray(cell["shards"].combine_chunks().flatten()).reshape(len(ids), -1)[order][some]
            near &= ~_meet(np.where(shards < shard, shards, -1))
        n = np.zeros(len(ids), np.int64)
        for low in range(0, len(some), 512):
            n[some[low : low + 512]] = near[low : low + 512] @ weight[some]
        # partners are named only where a vec_id with several vectors is one of the two
        a, b = np.nonzero(near & (repeats[some][:, None] | repeats[some]))
        offsets = np.searchsorted(some[a], np.arange(len(ids) + 1))
        named = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids[some[b]], pa.int64()))
        return pa.table({"id": ids, "n": n, "named": named, "root": root})

    return run


def _nearest(centres, joined: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 1024):
                batch = whole.slice(low, 1024)
                sims = _matrix(batch.column("vector")) @ centres.value.T
                take = min(joined, sims.shape[1])
                best = np.argpartition(-sims, take - 1, axis=1)[:, :take].astype(np.int32)
                ends = pa.array(np.arange(0, best.size + 1, take), pa.int32())
                shards = pa.ListArray.from_arrays(ends, pa.array(best.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, shards], [*batch.schema.names, "shards"])

    return run


def overlap(centres: int) -> int:
    """Nearest centres whose shards a class joins: more of them where there are more centres to choose another one from."""
    return max(OVERLAP, math.ceil(PER_DOUBLING * math.log2(centres)))


def _centres(sample: np.ndarray, most: int) -> np.ndarray:
    kept, n = np.empty((most, sample.shape[1])), 0
    for row in sample:
        if n == most:
            break
        if not n or (kept[:n] @ row).max() < APART:
            kept[n] = row
            n += 1
    return kept[:n]


def _graph(classes: DataFrame, n: int, threshold: float, cell: int) -> DataFrame:
    """(id, n, named, root) for each class and each cell that it is in; ``classes`` are of one dimension."""
    spark = classes.sparkSession
    most = max(1, min(CENTRES, n // PER_CENTRE))
    rows = classes.orderBy(F.xxhash64("first"), "id").limit(2 * most).select("vector").toArrow()
    chosen = _centres(_matrix(rows["vector"]), most)
    centres = spark.sparkContext.broadcast(chosen)
    kind = classes.schema["vector"].dataType.simpleString()
    placed = durable(
        classes.select("id", "vector", "weight", "repeats").mapInArrow(
            _nearest(centres, overlap(len(chosen))), f"id long, vector {kind}, weight long, repeats boolean, shards array<int>"
        )
    )
    blocks = F.ceil(F.col("n") / (cell // 2)).cast("int")
    sizes = placed.select(F.explode("shards").alias("shard")).groupBy("shard").agg(F.count(F.lit(1)).alias("n"))  # at most CENTRES rows
    sizes = sizes.select("shard", F.when(F.col("n") > cell, blocks).otherwise(F.lit(1)).alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    placed = placed.withColumn("shard", F.explode("shards")).join(F.broadcast(sizes), "shard").withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = placed.select("*", other.alias("other")).select(
        "id", "vector", "weight", "repeats", "shards", "shard", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    )
    built = cells.select("id", "vector", "shard", "i", "j").groupBy("shard", "i", "j").applyInArrow(_build(threshold), "id long, next array<long>")
    united = durable(built.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("next"))).alias("next")))
    return cells.join(united, "id").groupBy("shard", "i", "j").applyInArrow(_links(threshold), "id long, n long, named array<long>, root long")


def near_vector_classes(vectors: DataFrame, threshold: float = 0.9, cell: int = CELL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding).

    n_links counts the other vec_ids whose vectors have a cosine of at least ``threshold``. Vectors that are null, empty, zero or
    hold a null or non-finite component link with nothing, and vectors link only with those of their own dimension. Rows
    without vec_id link with nothing, have no component_id, and are kept. Rows that repeat a vec_id and its
    vector count once; a vec_id with several vectors has the links of all. An empty table gives no rows.
    """
    single = vectors.schema["embedding"].dataType == T.ArrayType(T.FloatType(), vectors.schema["embedding"].dataType.containsNull)
    kind = "float" if single else "double"
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast(f"array<{kind}>").alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(finite & F.exists("vector", lambda v: v != 0), F.lit(False)) & F.col("vec_id").isNotNull()
    rows = durable(rows.select("vec_id", F.when(usable, F.transform("vector", lambda v: (v + 0.0).cast(kind))).alias("vector")))
    members = rows.filter("vector is not null").distinct()
    # a vec_id with several vectors is no part of a weight: it counts once for each partner, by name
    several = members.groupBy("vec_id").count().filter("count > 1").select("vec_id", F.lit(True).alias("several"))
    members = members.join(several, "vec_id", "left").withColumn("several", F.coalesce("several", F.lit(False)))
    weight, repeats = F.count(F.when(~F.col("several"), 1)), F.max("several")
    classes = members.groupBy("vector").agg(F.min("vec_id").alias("first"), weight.alias("weight"), repeats.alias("repeats"))
    classes = durable(classes.withColumn("id", F.monotonically_increasing_id()))
    found: DataFrame | None = None
    sizes = classes.groupBy(F.size("vector").alias("d")).count().collect()  # one row per dimension
    for d, n in sizes:
        part = _graph(classes.filter(F.size("vector") == d), n, threshold, cell)
        found = part if found is None else found.union(part)
    if found is None:
        linked = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        return linked.withColumn("kept", F.lit(True))
    found = durable(found)
    members = durable(members.join(classes.select("vector", "id"), "vector").select("vec_id", "several", "id"))
    repeated = members.filter("several").select("vec_id", "id")
    bound = repeated.groupBy("vec_id").agg(F.min("id").alias("a"), F.collect_list("id").alias("b")).select("a", F.explode("b").alias("b"))
    links = found.filter("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")).union(bound.filter("a <> b"))
    labels = classes.select("id", "first").join(components(links), "id", "left").withColumn("label", F.coalesce("component", "id"))
    labels = labels.select("id", "label").join(labels.groupBy("label").agg(F.min("first").alias("component")), "label").select("id", "component")
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    # pairs of classes with a repeated vec_id in one of them, each class with itself, too
    pairs = found.select("id", F.explode("named").alias("to")).union(classes.filter("repeats").select("id", F.col("id").alias("to")))
    by_name = pairs.join(repeated.select("vec_id", F.col("id").alias("to")), "to")
    extra = by_name.groupBy("id").agg(F.countDistinct("vec_id").alias("extra"))
    once = members.filter("not several").join(classes.select("id", "weight"), "id").join(counts, "id").join(extra, "id", "left")
    once = once.select("vec_id", "id", (F.col("n") + F.col("weight") - 1 + F.coalesce("extra", F.lit(0))).alias("n"))
    reached = repeated.join(pairs, "id").select("vec_id", "to").distinct()
    plain = reached.join(classes.select(F.col("id").alias("to"), "weight"), "to").groupBy("vec_id").agg(F.sum("weight").alias("plain"))
    others = reached.join(repeated.select(F.col("vec_id").alias("other"), F.col("id").alias("to")), "to").groupBy("vec_id").agg(F.countDistinct("other").alias("others"))
    any_class = repeated.groupBy("vec_id").agg(F.min("id").alias("id"))
    many = any_class.join(plain, "vec_id").join(others, "vec_id").select("vec_id", "id", (F.col("plain") + F.col("others") - 1).alias("n"))
    by_id = once.union(many).join(labels, "id").select("vec_id", "n", "component")
    return (
        rows.select("vec_id").join(by_id, "vec_id", "left")
        .select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )


def audit(vectors: DataFrame, result: DataFrame, threshold: float = 0.9, every: int = 20) -> float:
    """Share of the links of the vec_ids divisible by ``every`` that ``result`` counts: these are compared with all rows, in
    blocks that each hold one part of the queries. For tables whose vectors are all usable and of one dimension."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    queries = rows.filter(F.col("vec_id") % every == 0)
    parts = max(1, queries.count() // 2048)
    asked = queries.select("vec_id", "vector", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part"), F.lit(True).alias("asks"), F.explode(F.sequence(F.lit(0), F.lit(63))).alias("block"))
    given = rows.select("vec_id", "vector", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(False).alias("asks"), F.pmod(F.xxhash64("vec_id"), F.lit(64)).cast("int").alias("block"))

    def count(cell: pa.Table) -> pa.Table:
        asks = cell["asks"].to_numpy()
        x, ids = _matrix(cell["vector"]), cell["vec_id"].to_numpy()
        near = x[asks] @ x[~asks].T >= threshold
        near &= ids[asks][:, None] != ids[~asks]
        return pa.table({"vec_id": ids[asks], "n": near.sum(axis=1).astype(np.int64)})

    exact = asked.union(given).groupBy("part", "block").applyInArrow(count, "vec_id long, n long").groupBy("vec_id").agg(F.sum("n").alias("n"))
    both = exact.join(result, "vec_id").agg(F.sum("n").alias("n"), F.sum(F.least("n", "n_links")).alias("found")).first()
    return both.found / both.n if both.n else 1.0
