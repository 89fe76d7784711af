"""Language of whole texts: multinomial naive Bayes over hashed character n-grams.

Characters are lower-cased, everything but letters is blank, and runs of one to three characters are hashed into buckets.
Learning adds up counts per language inside the tasks and then over them; what reaches the driver is one matrix of languages
by BUCKETS. The matrix of log-probabilities goes to the tasks, which score a block of texts at a time in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
CHUNK = 1 << 12  # buckets in one row of partial counts
ORDERS = 3
BLOCK_CHARS = 1 << 20
MOST_LANGUAGES = 1000  # beyond, the column does not hold languages: learning stops with an error
UNKNOWN = "und"

_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _grams(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Of a block: bucket of the run of each order that begins at each character (BUCKETS for blanks), where each text
    begins, and how many letters it has."""
    padded = [f" {t.lower()}  " for t in texts]
    chars = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    begin = np.cumsum([0, *map(len, padded[:-1])])
    letter = _letters()[chars]
    chars = np.where(letter, chars, np.uint32(32))
    ahead = np.concatenate([chars, np.full(ORDERS, 32, np.uint32)])
    blank = (chars == 32) & (ahead[1 : 1 + len(chars)] == 32)
    out, mix = [], np.zeros(len(chars), np.uint32)
    for n in range(ORDERS):
        mix = (mix ^ ahead[n : n + len(chars)]) * _FACTORS[n]
        mix ^= mix >> np.uint32(15)
        bucket = ((mix * np.uint32(0x2545F491)) >> np.uint32(16)).astype(np.int32)
        bucket[blank] = BUCKETS
        out.append(bucket)
    return out, begin, np.add.reduceat(letter, begin, dtype=np.int64)


def _blocks(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of about BLOCK_CHARS characters, or one longer text."""
    held, size, first = [], 0, 0
    for i, t in enumerate(texts):
        t = t.as_py() or ""
        if held and size + len(t) > BLOCK_CHARS:
            yield first, held
            held, size, first = [], 0, i
        held.append(t)
        size += len(t)
    if held:
        yield first, held


def _counts(languages: list[str]):
    place = {lang: i for i, lang in enumerate(languages)}
    row = BUCKETS + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), row), np.int64)
        seen = False
        for batch in batches:
            own = np.array([place[x] for x in batch.column(1).to_pylist()])
            for first, texts in _blocks(batch.column(0)):
                seen = True
                grams, begin, _ = _grams(texts)
                length = np.diff(np.append(begin, len(grams[0])))
                of = np.repeat(own[first : first + len(texts)] * row, length)
                for g in grams:
                    total += np.bincount(of + g, minlength=total.size).reshape(total.shape)
        if seen:
            at = [(i, c) for i in range(len(languages)) for c in range(BUCKETS // CHUNK)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i for i, _ in at], pa.int32()),
                    pa.array([c for _, c in at], pa.int32()),
                    pa.array([total[i, c * CHUNK : (c + 1) * CHUNK].tobytes() for i, c in at], pa.binary()),
                ],
                ["lang", "chunk", "counts"],
            )

    return run


def _added(keys: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CHUNK, np.int64)
    for batch in batches:
        for counts in batch.column("counts"):
            total += np.frombuffer(counts.as_buffer(), np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array([keys[0].as_py()], pa.int32()), pa.array([keys[1].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
        ["lang", "chunk", "counts"],
    )


class LanguageModel:
    """Languages and their log-probabilities: BUCKETS columns, and one of zeros for blanks."""

    def __init__(self, languages: list[str], prior: np.ndarray, table: np.ndarray):
        self.languages, self.prior, self.table = languages, prior, table


def learn(rows: DataFrame) -> LanguageModel:
    """From all ``rows`` (text, lang) without nulls. No rows give a model without languages."""
    found = rows.groupBy("lang").count().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = [r.lang for r in found]
    if not languages:
        return LanguageModel([], np.zeros(0), np.zeros((0, BUCKETS + 1)))
    schema = "lang int, chunk int, counts binary"
    parts = rows.select("text", "lang").mapInArrow(_counts(languages), schema).groupBy("lang", "chunk").applyInArrow(_added, schema)
    counts = np.zeros((len(languages), BUCKETS))
    for r in parts.collect():
        counts[r.lang, r.chunk * CHUNK : (r.chunk + 1) * CHUNK] = np.frombuffer(r.counts, np.int64)
    smooth = counts + 0.1
    table = np.zeros((len(languages), BUCKETS + 1))
    table[:, :BUCKETS] = np.log(smooth / smooth.sum(axis=1, keepdims=True))
    prior = np.array([r["count"] for r in found], float)
    return LanguageModel(languages, np.log(prior / prior.sum()), table)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score) per row; the score is the model's probability of what it predicts.

    ``und`` with score 0 for text that is null or has no letter, and for all if nothing was learned.
    """
    session = docs.sparkSession
    shared = session.sparkContext.broadcast((model.languages, model.prior, model.table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, prior, table = shared.value
        for batch in batches:
            for first, texts in _blocks(batch.column(1)):
                grams, begin, letters = _grams(texts)
                names = np.full(len(texts), UNKNOWN, object)
                score = np.zeros(len(texts))
                if languages:
                    sums = np.stack([np.add.reduceat(t[grams[0]] + t[grams[1]] + t[grams[2]], begin) for t in table], axis=1)
                    sums += prior
                    best = sums.argmax(axis=1)
                    odds = np.exp(sums - sums.max(axis=1, keepdims=True))
                    sure = letters > 0
                    names[sure] = np.array(languages, object)[best][sure]
                    score[sure] = (1 / odds.sum(axis=1))[sure]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                    ["doc_id", "lang_pred", "score"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def remainder(doc_id: Column, folds: int) -> Column:
    """crc32 of doc_id as text, modulo ``folds``; null for no doc_id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def languages_held_out(docs: DataFrame, folds: int = 5) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learned from labelled rows outside fold 0, predicted for all rows.

    Rows without doc_id are in no fold: they are neither learned from nor held out.
    """
    fold = remainder(F.col("doc_id"), folds)
    known = docs.filter((fold != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    model = learn(known.select(F.col("text").cast("string"), F.col("lang").cast("string")))
    held = F.coalesce(remainder(F.col("doc_id"), folds) == 0, F.lit(False))
    return predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")
