"""A trie over the prefixes of conversations, kept as a z-fast trie: a dictionary of compacted nodes.

A conversation is a sequence of turns, and a key of 16 bytes stands for each of its prefixes. A compacted node is an edge: it
covers the depths from below its parent's extent to its own extent, where conversations branch or end. The dictionary
holds it under its handle, the key at the two-fattest depth of that range (the depth divisible by the largest power of two). A
conversation finds the node where it leaves the trie by a fat binary search over its own depths: one dictionary join
for each halving. Conversations are inserted in batches that double in size: the ones of a batch locate their exits
together, split edges where they leave them, and hang the compacted trie of what is left of them below.

Equal conversations are one sequence with a weight before any of that, so a conversation that many repeat is inserted once.
Sums over subtrees run over compacted nodes by doubling: after k rounds a node has the sums of all nodes less than
2**k below it. Last, edges are expanded into one row per depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfbook.session import durable

SHARE = 20  # the first turns of conv_id - conv_id % SHARE come first
SHARED = 4  # the shared turns are crc32(conv_id) % SHARED
PARTS = 7  # batches take 1, 2 and 4 of so many parts of the sequences
ROOT = b""
NODE = ("ext", "ext_len", "par", "par_len", "name", "handle", "keys", "words")


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each turn: a key of its role and text, and the words of its text."""
    for batch in batches:
        keys, words = [], []
        for role, text in zip(batch.column(2), batch.column(3)):
            role, text = (x.as_buffer().to_pybytes() if x.is_valid else b"" for x in (role, text))
            keys.append(hashlib.blake2b(len(role).to_bytes(8) + role + text, digest_size=16).digest())
            words.append(len(text.split()))
        columns = [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(words, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["conv", "turn", "own", "n_words"])


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of conversation and depth: the key of each prefix and the words up to it."""
    conv, key, words = None, ROOT, 0
    for batch in batches:
        keys, sums = [], []
        for c, own, n in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
            if c != conv:
                conv, key, words = c, ROOT, 0
            key = hashlib.blake2b(key + own, digest_size=16).digest()
            words += n
            keys.append(key)
            sums.append(words)
        columns = [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(sums, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["conv", "depth", "key", "words"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of end and conversation: one digest for each end, worked on as the rows pass."""
    end, digest = None, None
    for batch in batches:
        ends = batch.column(0)
        texts = batch.column(1).cast(pa.string())
        runs = pc.run_end_encode(ends)
        done: list[tuple[bytes, str]] = []
        at = 0
        for value, to in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
            if value != end:
                if digest is not None:
                    done.append((end, digest.hexdigest()))
                end, digest = value, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(",".join(texts.slice(at, to - at).to_pylist()).encode())
            at = to
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], k) for i, k in enumerate((pa.binary(), pa.string()))], ["ext", "ends_sha256"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([end], pa.binary()), pa.array([digest.hexdigest()])], ["ext", "ends_sha256"])


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv, depth, own, n_words) of every turn of the rebuilt conversations, all conversations (conv, n))."""
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    rows = rows.filter("conv_id is not null").mapInArrow(_turns, "conv long, turn long, own binary, n_words long")
    order = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "own")
    placed = durable(rows.withColumn("pos", F.row_number().over(order).cast("long")).select("conv", "pos", "own", "n_words"))
    counts = placed.groupBy("conv").agg(F.max("pos").alias("n"))
    heads = counts.select("conv", "n", (F.col("conv") - F.col("conv") % SHARE).alias("base"), (F.crc32(F.col("conv").cast("string")) % SHARED).cast("int").alias("h"))
    bases = counts.filter(F.col("conv") % SHARE == 0).select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    heads = durable(heads.join(bases, "base", "left").withColumn("f", F.least("h", F.coalesce("n_base", F.lit(0)))).select("conv", "n", "base", "h", "f"))
    own = placed.join(heads.select("conv", "h", "f"), "conv").filter("pos > h").select("conv", (F.col("pos") - F.col("h") + F.col("f")).alias("depth"), "own", "n_words")
    first = placed.filter((F.col("conv") % SHARE == 0) & (F.col("pos") < SHARED)).withColumnRenamed("conv", "base")
    shared = heads.filter("f > 0").select("conv", "base", "f").join(first, "base").filter("pos <= f").select("conv", F.col("pos").alias("depth"), "own", "n_words")
    convs = heads.select("conv", (F.col("f") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n"))
    return own.union(shared), convs


def _two_fattest(a: Column, b: Column) -> Column:
    """The number in (a, b] that is divisible by the largest power of two; ``a`` is less than ``b``."""
    power = F.length(F.bin(a.bitwiseXOR(b))) - 1
    return F.call_function("shiftleft", F.lit(-1).cast("long"), power).bitwiseAND(b)


def _nodes(rows: DataFrame) -> DataFrame:
    """Adds name and handle to (par, par_len, ext_len, keys, words); keys and words are those of the edge's depths."""
    at = lambda depth: F.element_at("keys", (depth - F.col("par_len")).cast("int"))
    fat = _two_fattest(F.col("par_len"), F.col("ext_len"))
    return rows.select(
        at(F.col("ext_len")).alias("ext"), "ext_len", "par", "par_len", at(F.col("par_len") + 1).alias("name"), at(fat).alias("handle"), "keys", "words"
    )


def locate(queries: DataFrame, nodes: DataFrame, deepest: int) -> DataFrame:
    """Where each sequence (keys, words, n) leaves the trie.

    Adds ``edge`` (the extent of the node it leaves within, null if it leaves at a node), ``at`` (depth of the last common
    prefix) and ``par_len`` of the edge. Each round asks the dictionary for the two-fattest depth of what is left of the range
    (low, high]: with a node there whose extent the sequence passes, low rises to that extent; with a node that it
    does not pass, this is its edge; with none, high falls below that depth.
    """
    dictionary = nodes.select(F.col("handle").alias("asked"), F.col("ext").alias("f_ext"), F.col("ext_len").alias("f_len"))
    rows = queries.withColumns({"low": F.lit(0).cast("long"), "high": F.col("n"), "edge": F.lit(None).cast("binary")})
    kept = rows.columns
    for _ in range(max(1, deepest).bit_length()):
        open_ = F.col("edge").isNull() & (F.col("low") < F.col("high"))
        rows = rows.withColumn("fat", F.when(open_, _two_fattest(F.col("low"), F.col("high"))))
        rows = rows.withColumn("asked", F.when(open_, F.get("keys", (F.col("fat") - 1).cast("int"))))
        rows = rows.join(dictionary, "asked", "left")
        passed = F.coalesce(F.get("keys", (F.col("f_len") - 1).cast("int")) == F.col("f_ext"), F.lit(False))
        found = F.col("f_ext").isNotNull()
        rows = rows.withColumns(
            {
                "low": F.when(open_ & found & passed, F.col("f_len")).otherwise(F.col("low")),
                "high": F.when(open_ & ~found, F.col("fat") - 1).otherwise(F.col("high")),
                "edge": F.when(open_ & found & ~passed, F.col("f_ext")).otherwise(F.col("edge")),
            }
        ).select(*kept)
    # a sequence that goes on below the last node may do so along an edge that ends beyond it
    below = nodes.select(F.col("name").alias("asked"), F.col("ext").alias("n_ext"))
    rows = rows.withColumn("asked", F.when(F.col("edge").isNull(), F.get("keys", F.col("low").cast("int")))).join(below, "asked", "left")
    rows = rows.withColumn("edge", F.coalesce("edge", "n_ext")).drop("asked", "n_ext", "high")
    edges = nodes.select(F.col("ext").alias("edge"), "par_len", F.col("keys").alias("e_keys"))
    met = rows.join(edges, "edge", "left")
    same = F.zip_with(F.slice("keys", (F.col("par_len") + 1).cast("int"), F.size("e_keys")), "e_keys", lambda x, y: (x == y).cast("int"))
    shared = F.aggregate(same, F.lit(0), lambda total, x: total + F.coalesce(x, F.lit(0)))
    return met.select("keys", "words", "n", "edge", "par_len", F.coalesce(F.col("par_len") + shared, F.col("low")).cast("long").alias("at"))


def _pieces(rows: DataFrame) -> DataFrame:
    """(keys, words, low, cuts): edges cut at the depths ``cuts``; keys and words start at depth low + 1, ``top`` is the key at low."""
    spans = F.arrays_zip(F.concat(F.array("low"), "cuts").alias("a"), F.col("cuts").alias("b"))
    rows = rows.select("top", "low", "keys", "words", F.explode(F.slice(spans, 1, F.size("cuts"))).alias("span"))
    at, size = (F.col("span.a") - F.col("low")).cast("int"), (F.col("span.b") - F.col("span.a")).cast("int")
    above = F.when(at == 0, F.col("top")).otherwise(F.get("keys", at - 1))
    return rows.select(
        above.alias("par"), F.col("span.a").alias("par_len"), F.col("span.b").alias("ext_len"), F.slice("keys", at + 1, size).alias("keys"), F.slice("words", at + 1, size).alias("words")
    )


def insert(nodes: DataFrame, batch: DataFrame, deepest: int) -> DataFrame:
    """The trie with the sequences (keys, words, n) of a batch; none of them is empty or repeats."""
    found = durable(locate(batch, nodes, deepest))
    inside = F.col("edge").isNotNull()
    edges = nodes.select(F.col("ext").alias("edge"), "par", "ext_len", F.col("keys").alias("e_keys"), F.col("words").alias("e_words"))
    # edges that sequences leave or end within
    cuts = found.filter(inside).select("edge", "par_len", "at").distinct().join(nodes.select(F.col("ext").alias("edge"), "ext_len"), "edge").filter("at < ext_len")
    split = cuts.groupBy("edge", "par_len").agg(F.collect_set("at").alias("cuts")).join(edges, "edge")
    split = split.select(
        "edge", F.col("par").alias("top"), F.col("par_len").alias("low"), F.col("e_keys").alias("keys"), F.col("e_words").alias("words"),
        F.array_sort(F.concat("cuts", F.array("ext_len"))).alias("cuts"),
    )
    # what is left of the sequences below the trie, and where that branches or ends
    rest = found.filter("at < n").select(
        F.when(F.col("at") == 0, F.lit(ROOT)).otherwise(F.get("keys", (F.col("at") - 1).cast("int"))).alias("top"), F.col("at").alias("low"),
        F.slice("keys", (F.col("at") + 1).cast("int"), F.col("n").cast("int")).alias("keys"), F.slice("words", (F.col("at") + 1).cast("int"), F.col("n").cast("int")).alias("words"),
    )
    rest = durable(rest.withColumn("id", F.element_at("keys", -1)))
    places = rest.select("id", "low", F.posexplode("keys").alias("i", "key"), F.col("keys").alias("k"))
    places = places.select("id", (F.col("low") + F.col("i") + 1).alias("depth"), "key", F.get("k", F.col("i") + 1).alias("next"))
    marks = places.groupBy("key").agg(F.min("next").alias("a"), F.max("next").alias("b"), F.max(F.col("next").isNull()).alias("ends"))
    marks = marks.filter("ends or a <> b").select("key")
    explicit = places.join(marks, "key").groupBy("id").agg(F.array_sort(F.collect_list("depth")).alias("cuts"))
    fresh = _nodes(_pieces(rest.join(explicit, "id"))).dropDuplicates(["ext"])
    kept = nodes.join(split.select(F.col("edge").alias("ext")), "ext", "left_anti")
    return durable(kept.select(*NODE).unionByName(_nodes(_pieces(split))).unionByName(fresh))


def _with_sums(nodes: DataFrame) -> DataFrame:
    """Adds to each node the sums over its subtree: members, their smallest, their words, the words of its edges, its leaves."""
    sums = ("members", "least", "member_words", "edge_words", "leaves")
    fold = lambda c: F.min(c) if c == "least" else F.sum(c)
    both = lambda c, d: F.least(c, d) if c == "least" else F.col(c) + F.coalesce(d, F.lit(0))
    rows = nodes.select("ext", F.col("par").alias("up"), *sums)
    while True:
        below = rows.filter("up is not null").groupBy("up").agg(*[fold(c).alias(f"b_{c}") for c in sums])
        above = rows.select(F.col("ext").alias("up"), F.col("up").alias("next"))
        rows = rows.join(above, "up", "left").join(below.withColumnRenamed("up", "ext"), "ext", "left")
        rows = durable(rows.select("ext", F.col("next").alias("up"), *[both(c, F.col(f"b_{c}")).alias(c) for c in sums]))
        if rows.filter("up is not null").isEmpty():
            return rows.drop("up")


def trie_nodes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): one row per distinct prefix.

    Reads conv_id, turn, role and text. Turns are ordered by turn, null first, and turns of equal number by a hash of role and
    text, so repeated rows are turns of their own. Null role or text is empty; texts of any length are read whole. Rows without
    conv_id belong to no conversation. An empty table gives no rows, not even a root. Prefixes are told apart
    by 128-bit hashes. A conversation is one stream and then one array of 16 bytes for each of its turns; the
    conversations that end at a node pass through one digest, in order and in bounded memory.
    """
    rows, convs = rebuilt(turns)
    paths = rows.repartition("conv").sortWithinPartitions("conv", "depth").mapInArrow(_prefixes, "conv long, depth long, key binary, words long")
    paths = durable(paths)
    last = paths.select("conv", F.col("depth").alias("n"), F.col("key").alias("end"), F.col("words").alias("total"))
    ends = convs.join(last, ["conv", "n"], "left").select("conv", "n", F.coalesce("end", F.lit(ROOT)).alias("end"), F.coalesce("total", F.lit(0)).alias("total"))
    ends = durable(ends)
    kinds = durable(ends.groupBy("end").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("weight"), F.max("n").alias("n"), F.max("total").alias("total")))
    deepest = kinds.agg(F.max("n")).first()[0]
    if deepest is None:
        return turns.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    steps = paths.join(kinds.select("conv"), "conv", "left_semi").groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("depth", "key", "words"))).alias("path"))
    part = F.pmod(F.xxhash64("conv"), F.lit(PARTS))
    batch = F.when(part < 1, 0).when(part < 3, 1).otherwise(2)
    sequences = durable(steps.select(F.col("path.key").alias("keys"), F.col("path.words").alias("words"), F.size("path").cast("long").alias("n"), batch.alias("batch")))
    root = "ext binary, ext_len long, par binary, par_len long, name binary, handle binary, keys array<binary>, words array<long>"
    nodes = turns.sparkSession.createDataFrame([(ROOT, 0, None, -1, None, None, [ROOT], [0])], root)
    for i in range(3):
        nodes = insert(nodes, sequences.filter(F.col("batch") == i).drop("batch"), deepest)

    own = kinds.select(F.col("end").alias("ext"), F.col("weight").alias("members"), F.col("conv").alias("least"), (F.col("weight") * F.col("total")).alias("member_words"))
    children = nodes.filter("par is not null").groupBy("par").agg(F.count(F.lit(1)).alias("n_children")).withColumnRenamed("par", "ext")
    before = F.when(F.col("par_len") < 1, F.lit(0))  # words above the edge are known from its parent's last sum
    tops = nodes.select(F.col("ext").alias("par"), F.element_at("words", -1).alias("top_words"))
    nodes = nodes.join(own, "ext", "left").join(children, "ext", "left").join(tops, "par", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    nodes = durable(
        nodes.select(
            "ext", "par", "par_len", "words", F.coalesce(before, zero(F.col("top_words"))).alias("top_words"), zero(F.col("n_children")).alias("n_children"),
            zero(F.col("members")).alias("members"), "least", zero(F.col("member_words")).alias("member_words"),
            (F.element_at("words", -1) - F.coalesce(before, zero(F.col("top_words")))).alias("edge_words"), F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
        )
    )
    sums = _with_sums(nodes)
    digests = (
        ends.select("end", "conv").repartition("end").sortWithinPartitions("end", "conv").mapInArrow(_digests, "ext binary, ends_sha256 string")
    )
    nodes = nodes.select("ext", "par", "par_len", "words", "top_words", "n_children", F.col("edge_words").alias("own_words")).join(sums, "ext").join(digests, "ext", "left")
    above = sums.select(F.col("ext").alias("par"), F.col("least").alias("above"))
    edges = nodes.join(above, "par", "left")
    depths = edges.select("*", F.posexplode("words").alias("i", "upto"))
    bottom = F.col("i") == F.size("words") - 1
    until = F.when(F.col("i") == 0, F.col("top_words")).otherwise(F.get("words", F.col("i") - 1))  # words above this depth
    saved = F.col("member_words") - F.col("members") * until - (F.col("edge_words") - F.col("own_words") + F.element_at("words", -1) - until)
    return depths.select(
        F.col("least").alias("conv_id"),
        (F.col("par_len") + F.col("i") + 1).cast("long").alias("depth"),
        F.when(F.col("i") == 0, F.col("above")).otherwise(F.col("least")).alias("parent_conv_id"),
        F.col("members").alias("n_convs"),
        F.when(bottom, F.col("n_children")).otherwise(1).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        saved.alias("saved_tokens"),
        F.when(bottom & F.col("ends_sha256").isNotNull(), F.col("ends_sha256")).otherwise(F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
