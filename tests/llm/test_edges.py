"""Nulls in any column, empty and very long texts, repeated rows, empty tables, and extra columns of clashing names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfbook.llm.language import languages_held_out
from shelfbook.llm.mixing import mix_report, mixed
from shelfbook.llm.near_text import near_text_classes, without_near_copies
from shelfbook.llm.near_vectors import near_vector_classes
from shelfbook.llm.packing import packed, token_matrices
from shelfbook.llm.pseudonyms import pseudonym_report, pseudonymised
from shelfbook.llm.quality import accepted, quality_report
from shelfbook.llm.substrings import passage_digests, without_repeated_passages
from shelfbook.llm.toxicity import toxicity_held_out

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977}x{i % 89}" for i in range(60_000)) + " you idiot 4565410125667261"
ROWS = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n ", "en", None, 3), (4, "One", None, "a", 3),
    (5, LONG, "en", "b", len(LONG)), (6, LONG, "en", "b", len(LONG)), (7, "é ß 漢字 🙂", "de", "b", 1), (7, "é ß 漢字 🙂", "de", "b", 1),
    (None, "some text without a name", "en", "a", 5), (None, "some text without a name", "en", "a", 5), (8, "nul \x00 in it", "fr", "c", 9),
    (9, "some text without a name", None, "c", 5), (10, "1234 5678 !!", "en", "c", 5),
]
CLASHES = ("words", "text_", "size", "key", "kept", "score", "n_words", "found", "target", "copies", "node", "__at", "shard", "label")

OPERATORS = {
    "near": (near_text_classes, len(ROWS)),
    "packed": (packed, None),
    "tokens": (token_matrices, None),
    "mix": (mix_report, len(ROWS)),
    "mixed": (mixed, None),
    "passages": (passage_digests, len(ROWS)),
    "cut": (without_repeated_passages, len(ROWS)),
    "pseudonyms": (lambda d: pseudonym_report(d, "k"), len(ROWS)),
    "pseudonymised": (lambda d: pseudonymised(d, "k"), len(ROWS)),
    "language": (languages_held_out, len(ROWS)),
    "quality": (quality_report, len(ROWS)),
    "accepted": (accepted, None),
    "without": (without_near_copies, None),
    "toxicity": (lambda d: toxicity_held_out(d, d.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))), len(ROWS)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, name):
    run, count = OPERATORS[name]
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = run(docs).collect()
    assert count is None or len(got) == count
    wide = docs.select("*", *[F.lit(None).cast("int").alias(c) for c in CLASHES])
    again = run(wide).collect()
    assert len(again) == len(got)
    shown = lambda rows: sorted(str([r[c] for c in got[0].__fields__]) for r in rows)
    if got and name not in ("tokens", "packed"):  # equal rows of these may swap places
        assert shown(again) == shown(got)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    run, _ = OPERATORS[name]
    assert run(spark.createDataFrame([], SCHEMA)).collect() == []


def test_what_odd_rows_give(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    near = near_text_classes(docs, 3, 85).collect()
    assert {r.doc_id: r.component_id for r in near if r.doc_id in (1, 2, 3, 4, 6, 7)} == {1: 1, 2: 2, 3: 3, 4: 4, 6: 5, 7: 7}
    assert all(r.component_id is None and r.kept for r in near if r.doc_id is None)
    language = {r.doc_id: r for r in languages_held_out(docs).collect()}
    assert all(language[i].lang_pred == "und" and language[i].score == 0 for i in (1, 2, 3, 10))
    gone = {r.doc_id: r.n_removed for r in passage_digests(docs).collect() if r.doc_id}
    assert gone[6] > 59_000 and gone[5] < gone[6] and gone[7] == 0


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, None]), (8, []),
        (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (1, [1.0, 0.0]), (10, [1.0, 0.0]), (11, [-1.0, 0.0]), (12, [1e300, 1e300]), (13, [1e-300, 1e-300]),
    ]
    got = near_vector_classes(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == len(rows)
    links = {r.vec_id: (r.n_links, r.component_id) for r in got}
    assert links[1] == links[2] == links[10] == (2, 1) and links[12] == links[13] == (1, 12)
    assert all(links[i] == (0, i) for i in (3, 4, 5, 6, 7, 8, 9, 11)) and links[None] == (0, None)
    assert near_vector_classes(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
