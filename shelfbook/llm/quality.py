"""Quality rules with thresholds that follow the data: quantile sketches per language and source in place of fixed cutoffs.

Every document is measured in its own row. KLL sketches of five rates (symbols, capitals, word length, repeated lines, words
that repeat the one before) are built per (language, source) and merged upwards
to the language and to all, so a group with few documents takes the quantiles of the next wider one. A document is
rejected if a rate lies outside the fence of its group: the quartiles, moved outwards by a multiple of their distance.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfbook.llm.mixing import words

WINDOW = 8  # words
SKETCH = 4096  # k: exact up to about so many documents, a rank error of 0.1 % beyond
LEAST = 100  # documents that a group needs for quantiles of its own
REACH = 6.0  # quartile distances that a fence lies outside of the quartiles
#: least quartile distance of each rate, for groups in which all documents are alike
SPREADS = {"symbol_rate": 0.05, "capital_rate": 0.05, "word_length": 0.5, "line_rate": 0.1, "echo_rate": 0.05}


def _length_without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def rates(docs: DataFrame) -> DataFrame:
    """``docs`` as __row, with __lang and __source free of nulls, counts, and the rates that are sketched."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    rows = docs.select(F.struct("*").alias("__row"), text.alias("text"), key("lang").alias("__lang"), key("source").alias("__source"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    rows = rows.withColumns({"words": words(F.col("text")), "lines": lines}).withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "n_lines": F.size("lines").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "n_echoes": F.size(F.filter("words", lambda w, i: w == F.get("words", i - 1))).cast("long"),
            "word_chars": _length_without(F.col("text"), r"[ \t-\r]+"),
            "n_symbols": F.length("text") - _length_without(F.col("text"), r"[#*$%&|<>]"),
            "n_capitals": F.length("text") - _length_without(F.col("text"), r"\p{Lu}"),
        }
    )
    per = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    return rows.withColumns(
        {
            "symbol_rate": per("n_symbols", "n_words"),
            "capital_rate": per("n_capitals", "word_chars"),
            "word_length": per("word_chars", "n_words"),
            "line_rate": per("n_dup_lines", "n_lines"),
            "echo_rate": per("n_echoes", "n_words"),
        }
    )


def fences(rated: DataFrame) -> DataFrame:
    """(__lang, __source, <rate>_low, <rate>_high) for every group, from sketches of its own or of the next wider group."""
    one = rated.filter("n_words >= 20").groupBy("__lang", "__source").agg(
        F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(r, F.lit(SKETCH)).alias(r) for r in SPREADS]
    )
    merge = [F.kll_merge_agg_double(r, F.lit(SKETCH)).alias(r) for r in SPREADS]
    by_lang = one.groupBy("__lang").agg(F.sum("n").alias("n"), *merge)
    overall = one.agg(F.sum("n").alias("n"), *merge)
    at = F.array(F.lit(0.25), F.lit(0.75))

    def quartiles(df: DataFrame, level: str, *keys: str) -> DataFrame:
        return df.select(*keys, F.struct("n", *[F.kll_sketch_get_quantile_double(r, at).alias(r) for r in SPREADS]).alias(level))

    groups = rated.select("__lang", "__source").distinct()
    found = (
        groups.join(quartiles(one, "g", "__lang", "__source"), ["__lang", "__source"], "left")
        .join(quartiles(by_lang, "l", "__lang"), "__lang", "left")
        .join(F.broadcast(quartiles(overall, "a")), how="left")  # one row
    )
    out = []
    for rate, spread in SPREADS.items():
        q = F.when(F.col("g.n") >= LEAST, F.col(f"g.{rate}")).when(F.col("l.n") >= LEAST, F.col(f"l.{rate}")).otherwise(F.col(f"a.{rate}"))
        wide = F.greatest(F.get(q, 1) - F.get(q, 0), F.lit(spread)) * REACH
        out += [(F.get(q, 0) - wide).alias(f"{rate}_low"), (F.get(q, 1) + wide).alias(f"{rate}_high")]
    return found.select("__lang", "__source", *out)


def judged(docs: DataFrame) -> DataFrame:
    """``docs`` as __row, with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and kept.

    base_failed: under 20 words, or over 30 % of the words in 8-word windows that occur twice in the text. Null text
    counts as empty and fails; null languages and sources are groups of their own. An empty table gives no rows.
    """
    rated = rates(docs)
    edges = fences(rates(docs.select("lang", "source", "text")))
    starts = F.sequence(F.lit(0), F.col("n_words").cast("int") - WINDOW)
    hashes = F.when(F.col("n_words") >= WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice("words", i + 1, WINDOW))))
    measured = rated.withColumn("windows", hashes)
    # null where all windows differ, so that nothing below is worked out for these texts
    again = F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    measured = measured.withColumn("sorted", F.array_sort(again))
    none = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
    rest = F.size("sorted") - 1
    before = F.concat(none, F.slice("sorted", F.lit(1), rest))
    after = F.concat(F.slice("sorted", F.lit(2), rest), none)
    beside = F.arrays_zip(F.col("sorted").alias("own"), before.alias("before"), after.alias("after"))
    twice = F.filter(beside, lambda x: F.coalesce(x["own"]["h"] == x["before"]["h"], F.lit(False)) | F.coalesce(x["own"]["h"] == x["after"]["h"], F.lit(False)))
    places = F.sort_array(F.transform(twice, lambda x: x["own"]["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(F.lit(WINDOW), p - s["last"])).alias("n")),
        lambda s: s["n"],
    )
    measured = measured.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    within = [F.col(r).between(F.col(f"{r}_low"), F.col(f"{r}_high")) for r in SPREADS]
    fits = F.coalesce(reduce(Column.__and__, within), F.lit(True))  # no sketch at all: no document has 20 words
    return (
        measured.withColumn("base_failed", failed)
        .join(edges, ["__lang", "__source"], "left")
        .select(
            "__row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            (~F.col("base_failed") & fits).alias("kept"),
        )
    )


def quality_report(docs: DataFrame) -> DataFrame:
    """Counts and verdict of every row."""
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged(docs.select("doc_id", "lang", "source", "text")).select(F.col("__row.doc_id").cast("long").alias("doc_id"), *counts)


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep.

    The verdict is made to depend on a row number, so that the optimizer leaves the filter above it: pushed down, the
    measures would be written out in it several times over, and the arrays sorted again for each use.
    """
    verdict = F.col("kept") & (F.monotonically_increasing_id() >= 0)
    return judged(docs).select("__row", verdict.alias("__kept")).filter("__kept").select("__row.*")
