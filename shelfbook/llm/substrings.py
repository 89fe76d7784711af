"""Removal of long passages that an earlier document also has: Rabin-Karp hashes of every fixed-length word window.

Every window of every text is hashed from prefix sums. Within a block of texts only the smallest document that holds a
hash still matters for the others, so its later holders are settled on the spot, and at most one document for
each hash and block is shuffled. Blocks travel as packed arrays, dealt out by the leading bits of the hash; the receiving
task finds the smallest document of each hash and returns the places of later ones, packed again by document.
Last, repeated windows merge into maximal intervals, one row per document.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfbook.llm.wordhash import blocks

PACKED = "bucket int, hashes binary, ids binary, places binary"
TASK_BYTES = 24 << 20  # bytes of text for each receiving task


def pack(values: np.ndarray) -> bytes:
    """Byte planes of 64-bit or 32-bit integers: the leading bytes of sorted ones repeat and compress well."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def unpack(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _rows(bucket: list[int], hashes: list[bytes], ids: list[bytes], places: list[bytes]) -> pa.RecordBatch:
    binary = [pa.array(x, pa.binary()) for x in (hashes, ids, places)]
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), *binary], ["bucket", "hashes", "ids", "places"])


def _later(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For entries sorted by hash: whether each one's id is above the smallest of its hash; where hashes begin."""
    begin = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    least = np.minimum.reduceat(ids, begin)
    return ids > np.repeat(least, np.diff(np.append(begin, len(ids)))), begin


def _windows(width: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_ids = batch.column(0).to_numpy()
            for at, to, block in blocks(batch.column(1)):
                hashes, counts = block.runs(width)
                if not len(hashes):
                    continue
                text = np.repeat(np.arange(to - at, dtype=np.uint32), counts)
                place = (np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.uint32)
                order = np.argsort(hashes)
                hashes, text, place = hashes[order], text[order], place[order]
                ids = all_ids[at:to]
                later, _ = _later(hashes, ids[text])
                # settled here: no hashes, and places by document
                known = np.lexsort((place[later], text[later]))
                settled = (ids[text[later][known]], place[later][known])
                first = ~later
                hashes, text, place = hashes[first], text[first], place[first]
                ends = np.searchsorted(hashes >> np.uint64(64 - bits), np.arange((1 << bits) + 1))
                out: tuple[list, list, list, list] = ([], [], [], [])
                for b in np.flatnonzero(np.diff(ends)):
                    part = slice(ends[b], ends[b + 1])
                    held, own = np.unique(text[part], return_inverse=True)
                    out[0].append(int(b))
                    out[1].append(pack(hashes[part]))
                    out[2].append(np.uint32(len(held)).tobytes() + ids[held].tobytes() + pack(own.astype(np.uint32)))
                    out[3].append(pack(place[part]))
                if len(settled[0]):
                    out[0].append(int(hashes[0] >> np.uint64(64 - bits)) if len(hashes) else 0)
                    out[1].append(b"")
                    out[2].append(pack(settled[0]))
                    out[3].append(pack(settled[1]))
                yield _rows(*out)

    return run


def _by_document(ids: np.ndarray, places: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """Places of repeated windows, packed for the ``parts`` buckets of documents."""
    spread = ((ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(parts)
    order = np.lexsort((places, ids, spread))
    ids, places, spread = ids[order], places[order], spread[order]
    begin = np.flatnonzero(np.concatenate([[True], spread[1:] != spread[:-1]])) if len(ids) else []
    ends = [*begin[1:], len(ids)]
    if len(ids):
        yield _rows(
            [int(spread[b]) for b in begin], [b""] * len(begin),
            [pack(ids[b:e]) for b, e in zip(begin, ends)], [pack(places[b:e]) for b, e in zip(begin, ends)],
        )


def _repeated(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            for _, hashes, ids, places in zip(*(c.to_pylist() for c in batch.columns)):
                if not hashes:
                    yield from _by_document(unpack(ids, np.int64), unpack(places, np.uint32), parts)
                    continue
                n = int(np.frombuffer(ids[:4], np.uint32)[0])
                held, own = np.frombuffer(ids[4 : 4 + 8 * n], np.int64), unpack(ids[4 + 8 * n :], np.uint32)
                got.append((unpack(hashes, np.uint64), held[own], unpack(places, np.uint32)))
        if not got:
            return
        hashes, ids, places = (np.concatenate(x) for x in zip(*got))
        got.clear()
        order = np.argsort(hashes)
        hashes, ids, places = hashes[order], ids[order], places[order]
        later, _ = _later(hashes, ids)
        yield from _by_document(ids[later], places[later], parts)

    return run


def _intervals(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [
            (unpack(ids, np.int64), unpack(places, np.uint32))
            for batch in batches
            for ids, places in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
        ]
        if not got:
            return
        ids, places = (np.concatenate(x) for x in zip(*got))
        got.clear()
        order = np.lexsort((places, ids))
        ids, places = ids[order], places[order].astype(np.int64)
        fresh = np.concatenate([[True], (ids[1:] != ids[:-1]) | (places[1:] > places[:-1] + width)])
        begin = np.flatnonzero(fresh)
        start, end = places[begin], places[np.append(begin[1:], len(ids)) - 1] + width
        owner = ids[begin]
        of = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        offsets = pa.array(np.append(of, len(owner)), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(owner[of], pa.int64()),
                *(pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (start, end)),
            ],
            ["doc_id", "starts", "ends"],
        )

    return run


def repeated_passages(docs: DataFrame, width: int = 50) -> DataFrame:
    """(doc_id, starts, ends): maximal intervals of words [start, end) of a document that are covered by windows of
    ``width`` words which also start in a document of a smaller doc_id. Documents without any have no row.

    Reads doc_id and text. Rows without doc_id or text take no part; rows that share a doc_id are one document given
    several times. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter("doc_id is not null and text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / TASK_BYTES))
    bits = max(6, math.ceil(math.log2(parts)) + 1)
    packed = rows.mapInArrow(_windows(width, bits), PACKED).repartition(parts, "bucket")
    later = packed.mapInArrow(_repeated(parts), PACKED).repartition(parts, "bucket")
    return later.mapInArrow(_intervals(width), "doc_id long, starts array<int>, ends array<int>")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: tuple[list, list, list] = ([], [], [])
        for text, starts, ends in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            words = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
            kept, at = [], 0
            for start, end in zip(starts or (), ends or ()):
                kept += words[at:start]
                at = end
            kept += words[at:]
            out[0].append(len(words))
            out[1].append(len(words) - len(kept))
            out[2].append(hashlib.sha256(b" ".join(kept)).hexdigest())
        kinds = (pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *map(pa.array, out, kinds)], ["doc_id", "n_words", "n_removed", "kept_sha256"]
        )


def passage_digests(docs: DataFrame, width: int = 50) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row: what ``repeated_passages`` leaves of each text."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = rows.join(repeated_passages(docs, width), "doc_id", "left")
    return found.mapInArrow(_digests, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeated_passages(docs: DataFrame, width: int = 50) -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text``: kept words joined by one space; texts without any stay."""
    spans = repeated_passages(docs, width).select(F.col("doc_id").alias("__id"), "starts", "ends")
    rows = docs.select(F.struct("*").alias("__row"), F.col("doc_id").cast("long").alias("__id")).join(spans, "__id", "left")
    words = F.filter(F.split("__row.text", r"[ \t-\r]+"), lambda w: w != "")
    gaps = F.arrays_zip(F.concat(F.array(F.lit(0)), F.col("ends")), F.concat(F.col("starts"), F.array(F.size(words))))
    left = F.flatten(F.transform(gaps, lambda g: F.slice(words, g["0"] + 1, g["1"] - g["0"])))
    text = F.when(F.col("starts").isNull(), F.col("__row.text")).otherwise(F.array_join(left, " "))
    return rows.select(F.col("__row").withField("text", text).alias("__row")).select("__row.*")
