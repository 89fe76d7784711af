"""Removal of repeated lines against levelled sorted runs of line hashes. DataFrame functions only.

A run is a table of the 128-bit hashes of line keys, bucketed and sorted by hash, each with the document that holds the
key first. Batches of documents come in order. The keys of a batch, aggregated before their shuffle and dealt out in the
buckets of the runs, are merge-anti-joined with each run, without moving a run; what no run holds becomes a run of its own on level 0.
A level that has ``FANOUT`` runs is compacted into one run of the next level, so there are few runs to meet and each key
is rewritten a logarithmic number of times.

A line goes if a run held its key before the batch, or if a smaller document of its own batch holds it. Only keys
that decide about some line meet the lines again.
"""

from __future__ import annotations

import math
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfbook.session import shared_folder, durable

FANOUT = 2  # runs of a level that become one of the next
BATCHES = 4  # of the registered query, by ranges of doc_id
LEAST = 10  # code points of a key that counts
BUCKET_ROWS = 2_000_000  # lines of the first batch for each bucket
KEY = ("h1", "h2")

# What is stripped from a line, and the letters that a key has in lower case.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    key = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(key) == F.char_length(key), F.lower(key)).otherwise(F.translate(key, UPPER, LOWER))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(id, text_hash, pos, h1, h2) of every line whose key has at least ``LEAST`` code points, of rows with a doc_id."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).filter("id is not null")
    lines = rows.select("id", F.xxhash64("text").alias("text_hash"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    keys = lines.select("id", "text_hash", "pos", line_key(F.col("line")).alias("key")).filter(F.char_length("key") >= LEAST)
    return keys.select("id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"))


class LineRuns:
    """The keys of all lines taken in so far."""

    def __init__(self, spark: SparkSession, buckets: int, fanout: int = FANOUT):
        self.spark, self.buckets, self.fanout = spark, buckets, fanout
        self.levels: list[list[str]] = []

    def _stored(self, rows: DataFrame) -> str:
        """``rows`` as a bucketed and sorted table in the shared folder."""
        name = f"line_run_{uuid.uuid4().hex}"
        writer = rows.write.format("parquet").bucketBy(self.buckets, *KEY).sortBy(*KEY)
        writer.option("path", f"{shared_folder(self.spark)}/{name}").saveAsTable(name)
        return name

    def compact(self) -> None:
        for level, runs in enumerate(self.levels):
            if len(runs) >= self.fanout:
                merged = reduce(DataFrame.union, [self.spark.table(r) for r in runs])
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(self._stored(merged.repartition(self.buckets, *KEY)))
                self.levels[level] = []

    def add(self, lines: DataFrame) -> DataFrame:
        """Takes in a batch of ``fingerprints``; (h1, h2, keeper) of the keys that decide about its lines.

        Lines of ids above the keeper go; keeper is null, and all lines go, where an earlier batch holds the key.
        """
        self.compact()
        keys = lines.groupBy(*KEY).agg(F.min("id").alias("first"), F.max("id").alias("last"))
        batch = self.spark.table(self._stored(keys))
        fresh = batch
        for run in (run for level in reversed(self.levels) for run in level):
            fresh = fresh.join(self.spark.table(run).hint("merge"), list(KEY), "left_anti")
        repeated = batch.filter(F.col("first") < F.col("last")).select(*KEY, F.col("first").alias("keeper"))
        if not any(self.levels):
            own, seen = self._stored(batch.select(*KEY)), None
        else:
            own = self._stored(fresh.select(*KEY))
            seen = batch.join(self.spark.table(own).hint("merge"), list(KEY), "left_anti").select(*KEY)
            repeated = repeated.join(self.spark.table(own).hint("merge"), list(KEY), "left_semi")
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(own)
        return repeated if seen is None else repeated.unionByName(seen.withColumn("keeper", F.lit(None).cast("long")))


def repeated_lines(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(id, text_hash, gone): sorted places of the lines of a text whose key a document of a smaller doc_id holds too.

    Texts are told apart by doc_id and hash. The batches are ranges of doc_id, so that the first holder is the smallest.
    """
    spark = docs.sparkSession
    lines = durable(fingerprints(docs))
    shares = [i / batches for i in range(1, batches)]
    cuts, n = lines.agg(F.percentile_approx("id", shares, 1000), F.count(F.lit(1))).first()
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / batches / BUCKET_ROWS))
    cuts = sorted(set(cuts or []))
    runs = LineRuns(spark, buckets, fanout)
    number = reduce(lambda total, cut: total + (F.col("id") > cut).cast("int"), cuts, F.lit(0))
    deciding: DataFrame | None = None
    for i in range(len(cuts) + 1):
        low, high = F.col("id") > cuts[i - 1] if i else F.lit(True), F.col("id") <= cuts[i] if i < len(cuts) else F.lit(True)
        part = runs.add(lines.filter(low & high)).withColumn("batch", F.lit(i))
        deciding = part if deciding is None else deciding.unionByName(part)
    met = lines.withColumn("batch", number).join(deciding, ["batch", *KEY]).filter(F.col("keeper").isNull() | (F.col("id") > F.col("keeper")))
    return met.groupBy("id", "text_hash").agg(F.array_sort(F.collect_set("pos")).alias("gone"))


def _left(lines: Column, gone: Column) -> Column:
    """The lines between the places in ``gone``."""
    gaps = F.arrays_zip(F.concat(F.array(F.lit(-1)), gone).alias("after"), F.concat(gone, F.array(F.size(lines))).alias("until"))
    kept = F.flatten(F.transform(gaps, lambda g: F.slice(lines, g["after"] + 2, g["until"] - g["after"] - 1)))
    return F.when(gone.isNull(), lines).otherwise(kept)


def _met(docs: DataFrame, batches: int, fanout: int) -> DataFrame:
    rows = docs.select(F.struct("*").alias("__row"), F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("__text"))
    return rows.withColumn("text_hash", F.xxhash64("__text")).join(repeated_lines(docs, batches, fanout), ["id", "text_hash"], "left")


def line_digests(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) for every row of ``docs`` (doc_id, text; other columns are not read).

    Lines end at \\n; a null or empty text is one empty line. A line's key is the line without blanks at its ends and
    with A-Z in lower case. Keys of at least ten code points stay with the smallest doc_id that holds them, all their lines there.
    Keys are compared by two 64-bit hashes. Rows that share a doc_id are one document, equal or not. Rows without doc_id keep
    all their lines and take none from others. An empty table gives no rows. Texts of any length are read whole.
    """
    rows = _met(docs.select("doc_id", "text"), batches, fanout)
    lines = _lines(F.col("__text"))
    kept = F.array_join(_left(lines, F.col("gone")), "\n")
    return rows.select(
        F.col("id").alias("doc_id"),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(F.when(F.col("gone").isNull(), F.coalesce("__text", F.lit(""))).otherwise(kept), 256).alias("kept_sha256"),
    )


def without_repeated_lines(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``docs`` with the repeated lines cut out of ``text``; texts without any, null included, stay as they are."""
    rows = _met(docs, batches, fanout)
    kept = F.array_join(_left(_lines(F.col("__text")), F.col("gone")), "\n")
    text = F.when(F.col("gone").isNull(), F.col("__row.text")).otherwise(kept)
    return rows.select(F.col("__row").withField("text", text).alias("__row")).select("__row.*")
