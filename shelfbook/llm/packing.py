"""Packing documents into training sequences: variable-capacity best-fit, and token ids in fixed matrices.

Both deal the documents out to shards of bounded total size by a hash, and pack each shard on its own; at this size the loss
against packing all in one is below one sequence per shard and length. Longer documents are split without loss.
"""

from __future__ import annotations

import base64
import bisect
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfbook.llm.mixing import words
from shelfbook.session import durable

LENGTHS = (512, 1024, 2048, 4096)
OVERHEAD = 32  # cost of a sequence besides its length
SHARD = 1 << 21  # words or tokens
PIECES = 1 << 18  # of a shard, as many of its pieces may be empty


def best_fit(sizes: Sequence[int], lengths: Sequence[int], overhead: float = OVERHEAD) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each size, and the length of each bin; no size is above the greatest length.

    Largest first; an item goes to the open bin that it leaves least room in. If none has room, the length is opened
    that costs least for each unit it will hold: every length that takes the item is filled on trial with the largest of the
    sizes still to be placed that fit, and costs what it shrinks to, and the overhead, by what it then holds. Last, each bin
    shrinks to the shortest length that takes its contents.
    """
    lengths = sorted(lengths)
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    falling = [-sizes[i] for i in order]

    def cost(place: int, length: int) -> tuple[float, int]:
        held, at = -falling[place], place + 1
        while (at := bisect.bisect_left(falling, held - length, at)) < len(falling) and falling[at]:
            held -= falling[at]
            at += 1
        return (lengths[bisect.bisect_left(lengths, held)] + overhead) / max(1, held), length

    bins, offsets = [0] * len(sizes), [0] * len(sizes)
    used: list[int] = []
    open_: list[tuple[int, int]] = []  # (room, bin), sorted
    for place, i in enumerate(order):
        size = sizes[i]
        at = bisect.bisect_left(open_, (size, -1))
        if at < len(open_):
            room, bin_ = open_.pop(at)
        else:
            fits = lengths[bisect.bisect_left(lengths, size) :]
            room = min(cost(place, length) for length in fits)[1]
            bin_ = len(used)
            used.append(0)
        bins[i], offsets[i] = bin_, used[bin_]
        used[bin_] += size
        if room > size:
            bisect.insort(open_, (room - size, bin_))
    return bins, offsets, [lengths[bisect.bisect_left(lengths, u)] for u in used]


def _pack_sizes(lengths: Sequence[int], overhead: float):
    def run(keys: tuple, shard: pa.Table) -> pa.Table:
        size = shard["size"].to_numpy()
        order = np.lexsort((shard["start"].to_numpy(), shard["doc_id"].fill_null(-(1 << 63)).to_numpy(), -size))
        shard = shard.take(pa.array(order))
        bins, offsets, held = best_fit(size[order].tolist(), lengths, overhead)
        base = keys[0].as_py() << 32
        return pa.table(
            {
                "doc_id": shard["doc_id"], "piece": shard["piece"], "start": shard["start"], "size": shard["size"],
                "bin_id": pa.array([base + b for b in bins], pa.int64()), "bin_offset": pa.array(offsets, pa.int64()),
                "bin_length": pa.array([held[b] for b in bins], pa.int64()),
            }
        )

    return run


def packed(docs: DataFrame, lengths: Sequence[int] = LENGTHS, overhead: float = OVERHEAD, shard: int = SHARD) -> DataFrame:
    """(doc_id, piece, start, size, bin_id, bin_offset, bin_length): where each document's words go.

    A document of more words than the greatest length is cut into pieces of it; one without words has one piece of
    size 0, which takes no room. Repeated rows are packed each for itself. An empty table gives no rows.
    """
    longest = max(lengths)
    n = F.size(words(F.col("text").cast("string"))).cast("long")
    # the place of a row decides its shard, so that neither null nor repeated ids meet in one
    rows = durable(docs.select(F.col("doc_id").cast("long"), n.alias("words"), F.xxhash64("doc_id", F.monotonically_increasing_id()).alias("deal")))
    total, n_rows = rows.agg(F.sum("words"), F.count(F.lit(1))).first()
    shards = max(1, math.ceil((total or 0) / shard), math.ceil(n_rows / PIECES))
    last = F.greatest(F.lit(0), F.ceil(F.col("words") / longest) - 1).cast("int")
    pieces = rows.select("doc_id", "words", "deal", F.explode(F.sequence(F.lit(0), last)).alias("piece")).select(
        F.pmod(F.xxhash64("deal", "piece"), F.lit(shards)).alias("shard"), "doc_id", "piece",
        (F.col("piece").cast("long") * longest).alias("start"),
        F.least(F.lit(longest), F.col("words") - F.col("piece").cast("long") * longest).cast("long").alias("size"),
    )
    schema = "doc_id long, piece int, start long, size long, bin_id long, bin_offset long, bin_length long"
    return pieces.groupBy("shard").applyInArrow(_pack_sizes(lengths, overhead), schema)


# Fixed value: how the vocabulary's texts are cut before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PAD = 50_256  # free in that vocabulary
CAPACITY = 2048


class Encoder:
    """Ids of a text as little-endian 16-bit numbers. Texts are encoded whole: words repeat too rarely for keeping their ids to pay."""

    def __init__(self, ranks: bytes, pattern: str):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def __call__(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), "<u2").tobytes()


def _token_pieces(shared, pattern: str, capacity: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(shared.value, pattern)
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for doc_id, text, deal in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                ids = encode(text.as_py() or "")
                for start in range(0, max(1, len(ids) // 2), capacity):
                    out[0].append((deal + start // capacity * 0x9E3779B1) % shards)
                    out[1].append(doc_id)
                    out[2].append(start)
                    out[3].append(ids[2 * start : 2 * (start + capacity)])
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], ["shard", "doc_id", "start", "ids"])

    return run


class RoomTree:
    """Bins by the room they have left, in a segment tree over 0..capacity that finds the least room that suffices."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, n: int) -> None:
        at = room + self.size
        while at:
            self.count[at] += n
            at >>= 1

    def put(self, room: int, bin_: int) -> None:
        self.bins[room].append(bin_)
        self._add(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """(room, bin) with the least room that is at least ``least``; None if there is no such bin."""
        at = least + self.size
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):  # up, until a subtree to the right has a bin
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at + (not self.count[2 * at])
        room = at - self.size
        self._add(room, -1)
        return room, self.bins[room].pop()


def best_fit_decreasing(sizes: Sequence[int], capacity: int) -> list[list[int]]:
    """Items of each bin, in the order they were placed: largest first, each into the bin that it leaves least room in.

    A bin takes at most ``capacity`` items, which only empty ones can exceed.
    """
    tree, bins = RoomTree(capacity), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = tree.take(sizes[i])
        if found is None:
            found = capacity, len(bins)
            bins.append([])
        room, bin_ = found
        bins[bin_].append(i)
        if len(bins[bin_]) < capacity:
            tree.put(room - sizes[i], bin_)
    return bins


MATRIX = (
    "bin_id long, n_tokens int, input_ids binary, position_ids binary, cu_seqlens array<int>, doc_ids array<long>, token_starts array<long>"
)


def _matrix(capacity: int, pad: int):
    def run(keys: tuple, shard: pa.Table) -> pa.Table:
        size = pc.binary_length(shard["ids"]).to_numpy()
        last = shard["doc_id"].fill_null((1 << 63) - 1).to_numpy()
        shard = shard.take(pa.array(np.lexsort((shard["start"].to_numpy(), last, shard["doc_id"].is_null().to_numpy(), -size))))
        doc_id, start = shard["doc_id"].to_pylist(), shard["start"].to_pylist()
        ids = shard["ids"].to_pylist()
        sizes = [len(x) // 2 for x in ids]
        base = keys[0].as_py() << 32
        rows: dict[str, list] = {c.split()[0]: [] for c in MATRIX.split(", ")}
        for number, own in enumerate(best_fit_decreasing(sizes, capacity)):
            ends = np.cumsum([0, *(sizes[i] for i in own)])
            line = b"".join(ids[i] for i in own)
            place = np.zeros(capacity, "<u2")
            place[: ends[-1]] = np.arange(ends[-1]) - np.repeat(ends[:-1], np.diff(ends))
            rows["bin_id"].append(base + number)
            rows["n_tokens"].append(int(ends[-1]))
            rows["input_ids"].append(line + np.full(capacity - ends[-1], pad, "<u2").tobytes())
            rows["position_ids"].append(place.tobytes())
            rows["cu_seqlens"].append(ends.tolist())
            rows["doc_ids"].append([doc_id[i] for i in own])
            rows["token_starts"].append([start[i] for i in own])
        kinds = {
            "bin_id": pa.int64(), "n_tokens": pa.int32(), "input_ids": pa.binary(), "position_ids": pa.binary(),
            "cu_seqlens": pa.list_(pa.int32()), "doc_ids": pa.list_(pa.int64()), "token_starts": pa.list_(pa.int64()),
        }
        return pa.table({c: pa.array(v, kinds[c]) for c, v in rows.items()})

    return run


def token_matrices(
    docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN, capacity: int = CAPACITY, pad: int = PAD, shard: int = SHARD
) -> DataFrame:
    """One row per packed sequence of ``capacity`` token ids.

    input_ids and position_ids are little-endian 16-bit matrices rows (the vocabulary must have at most 65,536 ids, and the
    capacity must be at most as large), padded to the capacity. Segment i covers [cu_seqlens[i], cu_seqlens[i + 1]) and holds the tokens of doc_ids[i]
    from token_starts[i] on; positions restart with each segment. Documents above the capacity are cut into segments, which
    put together by token_starts give all their ids again; a null or empty text has one empty segment, and a sequence
    has at most ``capacity`` segments. The vocabulary file is read once, by the driver, and sent to the tasks. The segments are
    staged: the place of a row decides its shard, and a lost executor must not deal the rows out anew.
    """
    if capacity > 1 << 16:
        raise ValueError("capacity above 65,536")
    with open(vocabulary, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    # a token has about three bytes
    total, n_rows = docs.agg(F.sum(F.octet_length(F.col("text").cast("string"))), F.count(F.lit(1))).first()
    shards = max(1, math.ceil((total or 0) / 3 / shard), math.ceil(n_rows / PIECES))
    rows = docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"),
        F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(1 << 40)).alias("deal"),
    )
    pieces = rows.mapInArrow(_token_pieces(shared, pattern, capacity, shards), "shard long, doc_id long, start long, ids binary")
    return durable(pieces).groupBy("shard").applyInArrow(_matrix(capacity, pad), MATRIX)


def write_matrices(matrices: DataFrame, path: str) -> None:
    """Parquet files of the packed rows, one binary row of ids per sequence, written by the tasks."""
    matrices.write.parquet(path)
