"""Near-duplicate texts by a chosen-path set similarity join.

Every text is the set of its k-word shingles. Texts of equal sets become one class first. Then several independent
trees are grown over the classes: a node chooses ``branch`` places of the minhash signature, and each document goes to
the child named by its own value there, so two documents stay together with a chance that rises with their similarity.
Documents that are known to be linked carry a common label, brought up to date before each level, and a node of one label
is finished. A document outside its node's most frequent label is open. On the first level, nodes with few open documents
compare those with all others, and in the rest every document is compared with one pivot. After that, what is still
open in a node is compared with the whole node inside tasks that return only links that join labels, after the likeliest pairs
of its blocks were confirmed and their labels joined, so that few copies are made for cells; nodes with more
than ``PAIRS`` such pairs are compared with a pivot and branch again, along one path, so that a document never has more rows
than it had on the first level, and the copies made for cells grow with a node and not with its square. What is left after the last level is compared in cells of bounded size, however large the node is. A cell compares signatures
first; only documents with a partner by those are sent to it again with their texts. So a large group of near copies is linked by
stars, and its pairs are never rows.

Two documents of the wanted similarity s meet in a node of the first level with a chance of 1 - (1 - s)**(trees * branch):
0.9999998 for 0.85 and the default trees. A pair is dropped early only if its signatures agree in fewer places than five
standard deviations below the expected number; every other pair is confirmed on the full sets of its whole texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfbook.llm.graph import components
from shelfbook.llm.wordhash import Block, blocks, mixed
from shelfbook.session import durable

PLACES = 48  # of a signature
CELL = 512  # documents on each side of a cell
PAIRS = 64 * CELL * CELL  # of open documents with all others: a node of no more is compared in cells and not branched
_SEEDS = np.random.default_rng(77).integers(1, 1 << 62, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SUSPECT = "node long, id long, label long, side int, i int, j int"
SKETCH = "doc_id long, n_shingles long, h1 long, h2 long, signature array<int>"


def shingles(block: Block, k: int) -> list[np.ndarray]:
    """Of each text: the sorted distinct hashes of its k-word shingles; of fewer words, one hash of them all."""
    values, counts = block.runs(k)
    ends = np.cumsum(counts)
    words = np.diff(block.first)
    return [
        np.unique(values[e - c : e]) if c else np.array([block.short(i)] if words[i] else [], np.uint64)
        for i, (c, e) in enumerate(zip(counts, ends))
    ]


def _sketches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, block in blocks(batch.column(1), lower=True):
                sets = shingles(block, k)
                places = [
                    ((s[:, None] * _SEEDS) >> np.uint64(33)).min(axis=0).astype(np.int32) if len(s) else None for s in sets
                ]
                longs = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, to - at),
                        pa.array([len(s) for s in sets], pa.int64()),
                        longs([s.sum(dtype=np.uint64) for s in sets]),
                        longs([mixed(s ^ _SEEDS[0]).sum(dtype=np.uint64) for s in sets]),
                        pa.array(places, pa.list_(pa.int32())),
                    ],
                    ["doc_id", "n_shingles", "h1", "h2", "signature"],
                )

    return run


def _confirm(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                left, right = (
                    [s for _, _, block in blocks(batch.column(c), lower=True) for s in shingles(block, k)] for c in (2, 3)
                )
                same = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(left, right)]
                near = [100 * i >= percent * (len(x) + len(y) - i) and i > 0 for i, x, y in zip(same, left, right)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(near, pa.bool_()))

    return run


def _suspects(agreeing: int, percent: int):
    """Of a cell: its documents whose signature agrees often enough with that of one of another label on the other side."""

    def run(cell: pa.Table) -> pa.Table:
        cell = cell.combine_chunks()
        sizes, labels, side = (cell[c].to_numpy() for c in ("n", "label", "side"))
        places = cell["signature"].combine_chunks().flatten().to_numpy().reshape(-1, PLACES).T
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        alike = np.zeros((len(x), len(y)), np.uint8)
        for place in places:
            alike += place[x][:, None] == place[y]
        n, m = sizes[x][:, None], sizes[y]
        near = (alike >= agreeing) & (labels[x][:, None] != labels[y]) & (np.minimum(n, m) * 100 >= np.maximum(n, m) * percent)
        found = np.zeros(cell.num_rows, bool)
        found[x[near.any(axis=1)]] = True
        found[y[near.any(axis=0)]] = True
        return cell.drop_columns(["n", "signature"]).filter(pa.array(found))

    return run


def _likely(agreeing: int, percent: int):
    """Of a block of a node's documents: pairs that would join most of its labels, those whose signatures agree most before others."""

    def run(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        ids, sizes, labels = (block[c].to_numpy() for c in ("id", "n", "label"))
        places = block["signature"].combine_chunks().flatten().to_numpy().reshape(-1, PLACES).T
        alike = np.zeros((len(ids), len(ids)), np.uint8)
        for place in places:
            alike += place[:, None] == place
        n, m = sizes[:, None], sizes
        near = (alike >= agreeing) & (labels[:, None] != labels) & (np.minimum(n, m) * 100 >= np.maximum(n, m) * percent)
        i, j = np.nonzero(np.triu(near))
        order = np.argsort(-alike[i, j].astype(int), kind="stable")
        chosen = _joining(labels[i[order]].tolist(), labels[j[order]].tolist())
        a, b = ids[i[order][chosen]], ids[j[order][chosen]]
        return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})

    return run


def _joining(left: list[int], right: list[int]) -> list[int]:
    """Of links between labels, taken in order: the places of those that join labels that the ones before leave apart."""
    root: dict[int, int] = {}

    def find(v: int) -> int:
        while (up := root.get(v, v)) != v:
            root[v] = root.get(up, up)
            v = up
        return v

    chosen = []
    for at, (u, v) in enumerate(zip(left, right)):
        u, v = find(u), find(v)
        if u != v:
            root[u] = v
            chosen.append(at)
    return chosen


def _join_labels(k: int, percent: int):
    """Of a cell: links between its open documents (side 0) and the others, one for each two labels that they join."""

    def run(cell: pa.Table) -> pa.Table:
        cell = cell.combine_chunks()
        sets = [s for _, _, block in blocks(cell["text"], lower=True) for s in shingles(block, k)]
        ids, labels, side = (cell[c].to_numpy() for c in ("id", "label", "side"))
        sizes = np.array([len(s) for s in sets], np.float32)
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        owner = np.repeat(np.arange(len(sets)), sizes.astype(int))
        _, term, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = often[term] > 1
        owner, term = owner[shared], np.unique(term[shared], return_inverse=True)[1]
        order = np.argsort(term, kind="stable")
        owner, term = owner[order], term[order]
        row = np.empty(len(sets), int)
        row[x], row[y] = np.arange(len(x)), np.arange(len(y))
        both = np.zeros((len(x), len(y)), np.float32)
        width, n_terms = 2048, int(term[-1]) + 1 if len(term) else 0
        for low in range(0, n_terms, width):  # intersections as products of slices of 0/1 matrices
            part = slice(*np.searchsorted(term, [low, low + width]))
            held = [np.zeros((len(z), width), np.float32) for z in (x, y)]
            for s in (0, 1):
                mine = side[owner[part]] == s
                held[s][row[owner[part][mine]], term[part][mine] - low] = 1
            both += held[0] @ held[1].T
        near = (100 * both >= percent * (sizes[x][:, None] + sizes[y] - both)) & (both > 0)
        i, j = np.nonzero(near & (labels[x][:, None] != labels[y]))
        a, b = x[i], y[j]
        _, first = np.unique(np.stack([np.minimum(labels[a], labels[b]), np.maximum(labels[a], labels[b])]), axis=1, return_index=True)
        first = first[_joining(labels[a[first]].tolist(), labels[b[first]].tolist())]
        return pa.table({"a": pa.array(ids[a[first]], pa.int64()), "b": pa.array(ids[b[first]], pa.int64())})

    return run


def _sizes_allow(n: Column, m: Column, percent: int) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def near_text_classes(
    docs: DataFrame, k: int = 5, percent: int = 80, trees: int = 4, branch: int = 2, small: int = 32, levels: int = 8, exhaustive: int = PAIRS
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text; other columns are not read).

    Documents are linked if 100 * intersection >= ``percent`` * union of their shingle sets; component_id is the
    smallest doc_id that links lead to. Texts that are null or have no word have no shingle and are linked with
    nothing. Rows that share a doc_id are one document, linked by any of its texts. Rows without doc_id
    can't be named: they are linked with nothing, have no component_id, and are kept. An empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sketches = durable(texts.mapInArrow(_sketches(k), SKETCH))
    classes = (
        sketches.filter("n_shingles > 0 and doc_id is not null")
        .groupBy("n_shingles", "h1", "h2")
        .agg(F.min("doc_id").alias("id"), F.max("signature").alias("signature"))
    )
    classes = durable(classes)
    found = _labels(texts, classes, k, percent, trees, branch, small, levels, exhaustive)
    known = classes.join(found, "id", "left").select("n_shingles", "h1", "h2", F.coalesce("component", "id").alias("component"))
    named = sketches.filter("doc_id is not null").join(known, ["n_shingles", "h1", "h2"], "left")
    named = durable(named.select("doc_id", "n_shingles", "component"))
    # the texts of one doc_id hold their components together
    ends = named.groupBy("doc_id").agg(F.collect_set("component").alias("to")).filter(F.size("to") > 1)
    bound = durable(ends.select(F.array_min("to").alias("a"), F.explode("to").alias("b")).filter("a <> b").distinct())
    if not bound.isEmpty():
        merged = components(bound).select(F.col("id").alias("component"), F.col("component").alias("merged"))
        named = named.join(merged, "component", "left").withColumn("component", F.coalesce("merged", "component"))
    # a text without words is linked with nothing, but its document may be by another text
    by_doc = named.groupBy("doc_id").agg(F.min("component").alias("of_doc"))
    named = named.join(by_doc, "doc_id").withColumn("component", F.coalesce("component", "of_doc"))
    return (
        named.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .unionByName(sketches.filter("doc_id is null").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id")))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _labels(
    texts: DataFrame, classes: DataFrame, k: int, percent: int, trees: int, branch: int, small: int, levels: int, exhaustive: int
) -> DataFrame:
    """(id, component) of the classes that have confirmed links; enough links are found to connect all that are linked."""
    chance = percent / 100
    agreeing = math.floor(PLACES * chance - 5 * math.sqrt(PLACES * chance * (1 - chance)))
    signatures = classes.select("id", "signature")
    at = F.explode(F.sequence(F.lit(0), F.lit(trees * branch - 1)))
    rows = (
        classes.select("id", F.col("n_shingles").alias("n"), F.col("id").alias("label"), "signature", at.alias("at"))
        .select("id", "n", "label", F.xxhash64("at", F.get("signature", "at")).alias("node"))
    )

    def open_nodes(rows: DataFrame, turn: Column) -> DataFrame:
        """A node's documents by label; all but the most frequent label's are open. The pivot is the first of these by ``turn``."""
        by_label = rows.groupBy("node", "label").agg(
            F.count(F.lit(1)).alias("n_label"), F.min(F.struct(turn.alias("turn"), "id", "n")).alias("pivot")
        )
        return (
            by_label.groupBy("node")
            .agg(F.sum("n_label").alias("size"), F.max(F.struct("n_label", "label", "pivot")).alias("most"))
            .select("node", "size", "most.pivot", F.col("most.label").alias("common"), (F.col("size") - F.col("most.n_label")).alias("n_open"))
            .filter("n_open > 0")
        )

    def labelled(rows: DataFrame) -> DataFrame:
        return rows.join(labels, "id", "left").withColumn("label", F.coalesce("component", "id")).drop("component")

    labels: DataFrame | None = None
    candidates: DataFrame | None = None
    for level in range(1, levels + 1):
        first, last = level == 1, level == levels
        turn = F.col("id") if first else F.xxhash64("id", "node")
        grown = durable(rows.join(open_nodes(rows, turn), "node"))
        is_open = F.col("label") != F.col("common")
        ends_here = F.lit(True) if last else F.col("n_open") <= small if first else F.col("n_open") * F.col("size") <= exhaustive
        large = grown.filter(~ends_here)
        pairs = large.filter(is_open & _sizes_allow(F.col("n"), F.col("pivot.n"), percent)).select(
            F.least("pivot.id", "id").alias("a"), F.greatest("pivot.id", "id").alias("b")
        )
        if first:
            x = grown.filter(ends_here & is_open).select("node", "id", "n", "common")
            y = grown.filter(ends_here).select("node", *[F.col(c).alias(f"{c}_") for c in ("id", "n", "label")])
            once = (F.col("label_") == F.col("common")) | (F.col("id") < F.col("id_"))
            every = x.join(y, "node").filter((F.col("id") != F.col("id_")) & once & _sizes_allow(F.col("n"), F.col("n_"), percent))
            pairs = pairs.union(every.select(F.least("id", "id_").alias("a"), F.greatest("id", "id_").alias("b")))
        alike = F.aggregate(
            F.zip_with("sa", "sb", lambda p, q: (p == q).cast("int")), F.lit(0), lambda total, one: total + one
        )
        pairs = durable(
            pairs.distinct()
            .join(signatures.toDF("a", "sa"), "a")
            .join(signatures.toDF("b", "sb"), "b")
            .filter(alike >= agreeing)
            .select("a", "b")
        )
        if first:  # no later level asks for the text of any other document
            wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).union(large.select("id")).distinct()
            candidates = durable(texts.join(wanted, "doc_id", "left_semi"))
        blocks_of = lambda n: F.ceil(F.col(n) / CELL).cast("int")
        own = lambda n: F.pmod(F.xxhash64("id"), blocks_of(n)).cast("int")
        if not first:
            # likely pairs of bounded blocks first, so that few documents are open when a node meets itself in cells
            done = durable(grown.filter(ends_here).select("node", "id", "n", "label", "size").join(signatures, "id"))
            likely = done.withColumn("block", own("size")).groupBy("node", "block")
            pairs = durable(pairs.union(likely.applyInArrow(_likely(agreeing, percent), "a long, b long")).distinct())
        # a level moves the texts that it asks for, and no others, to its pairs and cells
        asked = durable(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
        read = candidates.join(asked, "doc_id", "left_semi")
        confirmed = (
            pairs.join(read.toDF("a", "ta"), "a")
            .join(read.toDF("b", "tb"), "b")
            .select("a", "b", "ta", "tb")
            .mapInArrow(_confirm(k, percent), "a long, b long")
        )
        labels = components(durable(confirmed), labels)
        if not first:
            each = lambda n: F.explode(F.sequence(F.lit(0), blocks_of(n) - 1))
            held = ("node", "id", "n", "label", "signature")
            now = labelled(done.select("node", "id", "n", "signature"))
            done = durable(now.join(open_nodes(now, F.col("id")).select("node", "size", "common", "n_open"), "node"))
            cells = done.filter(is_open).select(*held, F.lit(0).alias("side"), own("n_open").alias("i"), each("size").alias("j")).union(
                done.select(*held, F.lit(1).alias("side"), each("n_open").alias("i"), own("size").alias("j"))
            )
            # texts go only to cells where the document may have a partner
            suspects = durable(cells.groupBy("node", "i", "j").applyInArrow(_suspects(agreeing, percent), SUSPECT))
            read = candidates.join(durable(suspects.select(F.col("id").alias("doc_id")).distinct()), "doc_id", "left_semi")
            cells = suspects.join(read.toDF("id", "text"), "id")
            joined = cells.groupBy("node", "i", "j").applyInArrow(_join_labels(k, percent), "a long, b long")
            labels = components(durable(joined), labels)
        if large.isEmpty():
            break
        # each node chooses its place by its own name
        choice = F.pmod(F.xxhash64("node"), F.lit(PLACES)).cast("int")
        rows = (
            large.select("node", "id", "n")
            .join(labels, "id", "left")
            .join(signatures, "id")
            .select("id", "n", F.coalesce("component", "id").alias("label"), "node", "signature", choice.alias("at"))
            .select("id", "n", "label", F.xxhash64("node", "at", F.get("signature", "at")).alias("node"))
        )
    return labels


def without_near_copies(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group of near copies: the one of the smallest doc_id.

    Of rows that repeat a doc_id one stays (the least by its columns' text); rows without doc_id all stay.
    """
    classes = near_text_classes(docs, k, percent).filter("kept and doc_id is not null").select("doc_id").distinct()
    rows = docs.select(F.struct("*").alias("__row"), F.col("doc_id").cast("long").alias("__id"))
    first = Window.partitionBy("__id").orderBy(F.to_json("__row"))
    kept = (
        rows.join(classes.select(F.col("doc_id").alias("__id")), "__id", "left_semi")
        .withColumn("__at", F.row_number().over(first))
        .filter("__at = 1")
    )
    return kept.select("__row.*").union(rows.filter("__id is null").select("__row.*"))
