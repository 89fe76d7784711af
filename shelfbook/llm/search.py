"""Ranked lexical search with the roles reversed: a small index over the items meets every document once.

The items' terms form an inverted index (term -> items, with repeats) that is broadcast; items are dealt into blocks so that
no broadcast index weighs more than ``INDEX_BYTES``, and each block is searched on its own. A first pass over the whole
texts counts, per document, the terms that the index holds, and writes these counts as a narrow table; document
frequencies are sums over it. A second pass streams the counts through the postings and updates the best ``k``
documents of every item, so a task holds ``k`` rows an item and no more. Last, the tasks' bests are merged in two steps.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfbook.llm.mixing import running
from shelfbook.session import durable

INDEX_BYTES = 64 << 20  # of one broadcast index: its terms and POSTING for each of them
POSTING = 100
CELLS = 1 << 21  # scores and postings worked on at once
COUNTED = "doc_id long, n long, terms array<int>, tf array<long>"

# ASCII letters and digits and every byte of other characters make terms; A to Z are lower-cased.
_AS_TERM = bytes(
    b if b >= 0x80 or chr(b).isalnum() and not 0x41 <= b <= 0x5A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """The terms of a text, in order."""
    return text.translate(_AS_TERM).split()


def _texts(column: pa.Array) -> Iterator[bytes]:
    for text in column:
        yield text.as_buffer().to_pybytes() if text.is_valid else b""


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, text in enumerate(_texts(batch.column(1))):
            found = Counter(terms(text))
            if found:
                ids = pa.concat_arrays([batch.column(0).slice(at, 1)] * len(found))
                columns = [ids, pa.array(list(found), pa.binary()), pa.array(found.values(), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["item_id", "term", "repeats"])


class Index:
    """Postings of some items: for each term the items that hold it, and how often."""

    def __init__(self, rows: pa.Table):
        ids = rows["item_id"].combine_chunks().dictionary_encode(null_encoding="encode")
        words = rows["term"].combine_chunks().dictionary_encode()
        self.items = ids.dictionary.to_pylist()
        self.number = {t: i for i, t in enumerate(words.dictionary.to_pylist())}
        term, item, repeats = (np.asarray(x, np.int64) for x in (words.indices, ids.indices, rows["repeats"]))
        order = np.argsort(term, kind="stable")
        self.item, self.repeats = item[order], repeats[order]
        self.first = np.searchsorted(term[order], np.arange(len(self.number) + 1))


def _counted(index):
    """Of each text with a term: how many it has, and the counts of those that the index holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = index.value.number
        for batch in batches:
            kept: list[int] = []
            n: list[int] = []
            offsets, held, tf = [0], [], []
            for at, text in enumerate(_texts(batch.column(1))):
                own = terms(text)
                if not own:
                    continue
                counts = Counter(own)
                shared = number.keys() & counts.keys()
                kept.append(at)
                n.append(len(own))
                held += [number[t] for t in shared]
                tf += [counts[t] for t in shared]
                offsets.append(len(held))
            ends = pa.array(offsets, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, kind)) for x, kind in ((held, pa.int32()), (tf, pa.int64()))]
            ids = batch.column(0).take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "tf"])

    return run


class Best:
    """The best ``k`` documents of each item so far: by score, then by doc_id, those without doc_id last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.rows = np.zeros((4, 0), np.int64)  # item, negative score, whether unnamed, doc_id
        self.floor = np.ones(items, np.int64)  # least score that may enter
        self.worst = np.full(items, np.iinfo(np.int64).max)  # and the doc_id that such a score must stay below

    def take(self, scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        """``scores`` has one row for each document and one column for each item."""
        fits = (scores > self.floor) | ((scores == self.floor) & (ids[:, None] <= self.worst))
        doc, item = np.nonzero(fits)
        if not len(doc):
            return
        rows = np.concatenate([self.rows, np.stack([item, -scores[doc, item], unnamed[doc], ids[doc]])], axis=1)
        rows = rows[:, np.lexsort(rows[::-1])]
        begin = np.flatnonzero(np.concatenate([[True], rows[0, 1:] != rows[0, :-1]]))
        place = np.arange(rows.shape[1]) - np.repeat(begin, np.diff(np.append(begin, rows.shape[1])))
        self.rows = rows[:, place < self.k]
        last = rows[:, place == self.k - 1]
        self.floor[last[0]] = -last[1]
        self.worst[last[0]] = last[3]


def _searched(index, weights: np.ndarray, documents: int, length: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Index = index.value
        items = len(own.items)
        best = Best(items, k)
        for batch in batches:
            n = batch.column(1).to_numpy()
            ids = batch.column(0)
            unnamed = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
            m = np.array([100 - 75 + 75 * x * documents // length for x in n.tolist()], np.int64)
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            term = batch.column(2).flatten().to_numpy().astype(np.int64)
            tf = batch.column(3).flatten().to_numpy()
            doc = np.repeat(np.arange(len(n)), sizes)
            value = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
            spread = own.first[term + 1] - own.first[term]
            cost = np.cumsum(np.bincount(doc, spread, len(n)) + items)
            at = 0
            while at < len(n):
                to = max(at + 1, int(np.searchsorted(cost, (cost[at - 1] if at else 0) + CELLS, side="right")))
                part = slice(*np.searchsorted(doc, [at, to]))
                width = spread[part]
                posting = np.repeat(own.first[term[part]] - np.cumsum(width) + width, width) + np.arange(width.sum())
                cell = np.repeat((doc[part] - at) * items, width) + own.item[posting]
                added = np.repeat(value[part], width) * own.repeats[posting]
                # sums in two halves stay exact in doubles
                high, low = (np.bincount(cell, half, (to - at) * items).astype(np.int64) for half in (added >> 26, added & ((1 << 26) - 1)))
                best.take(((high << 26) + low).reshape(to - at, items), ids[at:to], unnamed[at:to])
                at = to
        item, score, missing, ids = best.rows
        named = pa.array(ids, pa.int64(), mask=missing.astype(bool))
        item_ids = pa.array(own.items, pa.int64()).take(pa.array(item))
        yield pa.RecordBatch.from_arrays([item_ids, named, pa.array(-score, pa.int64())], ["item_id", "doc_id", "score"])

    return run


def _block(docs: DataFrame, postings: DataFrame, k: int) -> DataFrame | None:
    context = docs.sparkSession.sparkContext
    index = context.broadcast(Index(postings.select("item_id", "term", "repeats").toArrow()))  # at most INDEX_BYTES and one item
    counted = durable(docs.mapInArrow(_counted(index), COUNTED))
    documents, length = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not documents:
        return None
    holding = np.zeros(len(index.value.number), np.int64)
    for row in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row for each term of the index
        holding[row[0]] = row[1]
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in holding.tolist()], np.int64)
    return counted.mapInArrow(_searched(index, weights, documents, length, k), "item_id long, doc_id long, score long")


def _first(rows: DataFrame, k: int, *group: str) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of the highest scores above 0 for each item.

    Reads doc_id and text of ``docs``, item_id and text of ``items``. A text without terms, null or empty, is neither
    counted nor found, and an item without terms finds nothing. Texts of any length are read whole. Rows that share an
    item_id (or have none) are one item with the terms of all; rows that repeat a doc_id are documents of their own.
    Documents without doc_id count and can be found, after all others of their score. Equal scores rank by doc_id.
    Empty tables give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    texts = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    postings = texts.mapInArrow(_item_terms, "item_id long, term binary, repeats long")
    postings = durable(postings.groupBy("item_id", "term").agg(F.sum("repeats").alias("repeats")))
    weight = F.sum(F.octet_length("term") + POSTING)
    total = postings.agg(weight).first()[0]
    if total is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    if total <= INDEX_BYTES:
        parts = [postings]
    else:
        sizes = postings.groupBy("item_id").agg(weight.alias("size"))
        placed = running(sizes, [F.col("item_id")], {"before": F.col("size")})
        placed = durable(placed.select(F.col("item_id").alias("item"), F.floor(F.col("before") / INDEX_BYTES).alias("block")))
        numbers = [row[0] for row in placed.select("block").distinct().collect()]  # one for each INDEX_BYTES of the items
        parts = [postings.join(placed.filter(F.col("block") == b), F.col("item_id").eqNullSafe(F.col("item"))) for b in numbers]
    found: DataFrame | None = None
    for part in parts:
        block = _block(rows, part, k)
        found = block if found is None else found.union(block) if block is not None else found
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    near = _first(found.withColumn("task", F.pmod(F.spark_partition_id(), F.lit(64))), k, "item_id", "task").drop("task", "rank")
    return _first(near, k, "item_id").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
