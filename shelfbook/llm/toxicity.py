"""Toxicity scores: gradient-boosted trees over dense features of a text, calibrated by isotonic regression.

Learning takes a bounded sample of labelled rows, split in three by doc_id: one part gives the learned lexicon, one fits the
trees, one fits the calibration. Features and scores cover every whole text, in place, without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfbook.llm.language import remainder
from shelfbook.session import durable

SAMPLE = 30_000  # labelled rows at most that are learned from, the first by a hash of doc_id
LEXICON = 200  # learned words at most
HELD_OUT, FOLDS = 2, 4

# English insults.
INSULTS = (
    "clown", "creep", "disgusting", "dumb", "dumbass", "fool", "freak", "garbage", "hateful", "idiot", "idiots",
    "imbecile", "loser", "losers", "moron", "morons", "pathetic", "pig", "retard", "scum", "scumbag", "shut", "stupid",
    "sucks", "trash", "ugly", "vermin", "worthless",
)
# Pronouns of the second person in English, German, French and Spanish.
SECOND_PERSON = (
    "you", "your", "yours", "you're", "ur", "yourself", "du", "dich", "dir", "dein", "deine", "euch", "ihr",
    "tu", "te", "toi", "ton", "ta", "vous", "votre", "usted", "ustedes", "ti", "tus",
)
NEAR = 5  # words between an insult and a pronoun

_word = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_veiled = re.compile(r"\b[^\W\d_]+[0-9@$!*]+[^\W\d_][\w@$!*]*")
_folded = str.maketrans("0134578@$!", "oieastbasi", "*_")
_capital = re.compile(r"\b[A-ZÀ-ÖØ-Þ]{3,}\b")


def features(text: str, seeds: frozenset[str], learned: frozenset[str]) -> list[float]:
    """Dense features of one whole text; all zero for an empty one."""
    low = text.lower()
    found = _word.findall(low)
    n = max(1, len(found))
    letters = max(1, sum(map(len, found)))
    hits = [i for i, w in enumerate(found) if w in seeds or w in learned]
    seed, taught = sum(found[i] in seeds for i in hits), sum(found[i] in learned for i in hits)
    aimed = sum(any(w in _SECOND for w in found[max(0, i - NEAR) : i + NEAR + 1]) for i in hits)
    veiled = [w.translate(_folded) for w in _veiled.findall(low)]
    hidden = sum(w in seeds or w in learned for w in veiled)
    raised = letters - sum(map(len, re.findall(r"[a-zß-öø-ÿ]+", text)))
    marks = text.count("!") + text.count("?")
    points = marks + sum(map(text.count, ".,;:"))
    return [
        100 * seed / n, math.log1p(seed), 100 * taught / n, math.log1p(taught), 100 * hidden / n, aimed / n,
        aimed / max(1, len(hits)), max(0, raised) / letters, len(_capital.findall(text)) / n, marks / n, points / n,
        len(veiled) / n, math.log1p(len(found)), letters / n,
    ]


_SECOND = frozenset(SECOND_PERSON)
NAMES = (
    "seed_density", "seed_count", "learned_density", "learned_count", "hidden_density", "aimed_density", "aimed_share", "capitals",
    "raised_words", "mark_rate", "punctuation_rate", "veiled_rate", "length", "word_length",
)


def _featured(learned: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds, words = frozenset(INSULTS), frozenset(learned)
        for batch in batches:
            rows = [features(t.as_py() or "", seeds, words) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "dense"])

    return run


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, toxic and clean texts with it), added up within each batch."""
    for batch in batches:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
            counts[toxic].update({w for w in _word.findall((text.as_py() or "").lower()) if len(w) <= 40})
        words = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array([counts[1][w] for w in words], pa.int64()), pa.array([counts[0][w] for w in words], pa.int64())],
            ["word", "toxic", "clean"],
        )


def learn_lexicon(rows: DataFrame, most: int = LEXICON) -> list[str]:
    """Words that toxic texts hold at least twenty times as often as clean ones, the most frequent first."""
    of = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not of.get(1) or not of.get(0):
        return []
    words = rows.select("text", "toxic").mapInArrow(_word_rows, "word string, toxic long, clean long")
    words = words.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = ((F.col("toxic") + 0.5) / (of[1] + 1)) / ((F.col("clean") + 0.5) / (of[0] + 1))
    enough = F.col("toxic") >= max(3, 0.005 * of[1])
    return sorted(r.word for r in words.filter(enough & (odds >= 20)).orderBy(F.desc("toxic"), "word").limit(most).collect())


class ToxicityModel:
    def __init__(self, lexicon: list[str], trees: Model | None, calibration: Model | None, share: float):
        self.lexicon, self.trees, self.calibration, self.share = lexicon, trees, calibration, share

    def score(self, docs: DataFrame) -> DataFrame:
        """(doc_id, score) for every row; null text counts as empty."""
        rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        if self.trees is None:
            return rows.select("doc_id", F.lit(self.share).alias("score"))
        dense = rows.mapInArrow(_featured(self.lexicon), "doc_id long, dense array<double>")
        raw = _raw(self.trees, dense)
        if self.calibration is None:
            return raw.select("doc_id", F.col("raw").alias("score"))
        # the raw score separates what the steps of the calibration make equal
        fitted = self.calibration.transform(raw)
        return fitted.select("doc_id", (F.col("calibrated") * 0.99 + F.col("raw") * 0.01).alias("score"))


def _raw(trees: Model, dense: DataFrame) -> DataFrame:
    scored = trees.transform(dense.withColumn("features", array_to_vector("dense")))
    return scored.withColumn("raw", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    """From at most ``sample`` rows with a label of 0 or 1 outside the held-out fold.

    Without labels of both kinds in the part for the trees, every score is the share of toxic labels (0 without labels).
    Of several labels of a doc_id the greatest counts; rows that repeat a doc_id are all learned from.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
        .filter((remainder(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("toxic").isin(0, 1))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    fold = remainder(F.col("doc_id"), FOLDS)
    # at most ``sample`` rows of two numbers
    rows = durable(texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic", fold.cast("int").alias("fold")))
    lexicon = learn_lexicon(rows.filter("fold = 0"))
    # one partition: the sums of the fit are then the same in every run
    dense = rows.select("doc_id", "text").mapInArrow(_featured(lexicon), "doc_id long, dense array<double>")
    dense = durable(dense.join(F.broadcast(chosen), "doc_id").select("doc_id", "dense", "toxic", fold.cast("int").alias("fold")))
    dense = dense.coalesce(1).sortWithinPartitions("doc_id", "dense")
    count = {(r.fold, r.toxic): r["count"] for r in rows.groupBy("fold", "toxic").count().collect()}
    share = sum(n for (_, t), n in count.items() if t) / max(1, sum(count.values()))
    if not count.get((1, 0)) or not count.get((1, 1)):
        return ToxicityModel(lexicon, None, None, float(share))
    booster = GBTClassifier(featuresCol="features", labelCol="toxic", maxIter=20, maxDepth=3, stepSize=0.3, maxBins=32, seed=7)
    trees = booster.fit(dense.filter("fold = 1").select(array_to_vector("dense").alias("features"), "toxic"))
    calibration = None
    if count.get((3, 0)) and count.get((3, 1)):
        isotonic = IsotonicRegression(featuresCol="raw", labelCol="toxic", predictionCol="calibrated")
        calibration = isotonic.fit(_raw(trees, dense.filter("fold = 3")).select("raw", F.col("toxic").cast("double")))
    return ToxicityModel(lexicon, trees, calibration, float(share))


def toxicity_held_out(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``; rows without doc_id are scored and not held out."""
    held = F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    scored = learn(docs, labels).score(docs)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
