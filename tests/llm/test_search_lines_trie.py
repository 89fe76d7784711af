"""Ranked search, line removal and the prefix trie against plain Python, on odd rows and on the tables."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from shelfbook.llm import lines as line_module
from shelfbook.llm import prefix_trie, search
from shelfbook.llm.lines import LineRuns, fingerprints, line_digests, without_repeated_lines
from shelfbook.llm.prefix_trie import trie_nodes
from shelfbook.llm.search import ranked_documents
from tests.llm import brute
from tests.llm.test_edges import CLASHES, ROWS, SCHEMA

FOLDER = "/root/testdata/sf0.001"
DOCS, ITEMS, TURNS = "doc_id long, text string", "item_id long, text string", "conv_id long, turn long, role string, text string"


def wide(df):
    return df.select("*", *[F.lit(None).cast("int").alias(c) for c in (*CLASHES, "conv", "rank", "item", "depth", "id", "pos", "h1", "gone", "text_hash")])


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def some_docs(seed, n):
    pick = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("Wort", "mot", "É", "x") for b in range(12)]
    rows = [(i * 3 % n, " ".join(pick.choices(vocabulary, k=pick.randrange(1, 40)))) for i in range(n)]
    return rows + [(n + i, rows[0][1]) for i in range(30)] + [(None, rows[0][1]), (None, rows[1][1]), (5, rows[0][1]), (n + 50, None), (n + 51, " .,-\x00 ")]


ITEM_ROWS = [(1, "wort1 WORT1 mot3-é4"), (2, None), (3, "nowhere"), (None, "mot5 x7"), (None, "x8"), (4, "x1\tx2 É3 wort4 wort4"), (4, "x11")]


@pytest.mark.parametrize("index_bytes", [1 << 26, 300])
def test_search(spark, monkeypatch, index_bytes):
    monkeypatch.setattr(search, "INDEX_BYTES", index_bytes)
    monkeypatch.setattr(search, "CELLS", 64)
    rows = some_docs(4, 200)
    docs, items = spark.createDataFrame(rows, DOCS).repartition(3), spark.createDataFrame(ITEM_ROWS, ITEMS)
    want = sorted(brute.ranked(rows, ITEM_ROWS), key=repr)
    assert tuples(ranked_documents(docs, items)) == want
    assert tuples(ranked_documents(wide(docs), wide(items))) == want


def test_search_of_odd_rows(spark):
    docs, items = spark.createDataFrame(ROWS, SCHEMA), spark.createDataFrame(ITEM_ROWS + [(9, "some TEXT word5x5"), (10, "漢字 🙂")], ITEMS)
    want = brute.ranked([r[:2] for r in ROWS], ITEM_ROWS + [(9, "some TEXT word5x5"), (10, "漢字 🙂")])
    assert tuples(ranked_documents(docs, items)) == sorted(want, key=repr)
    for empty in ((docs.limit(0), items), (docs, items.limit(0)), (docs.limit(0), items.limit(0)), (docs.filter("text is null"), items)):
        assert ranked_documents(*empty).collect() == []


def test_search_of_the_tables(spark):
    docs, items = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    want = brute.ranked([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert tuples(ranked_documents(docs, items)) == sorted(want, key=repr)


LINES = ["A line of its own", "  a LINE of its own\t", "short", "SHORT ", "Zeile mit Ä und É.", "zeile mit Ä und É.", "zeile mit ä und é.", "", " ", "another line here", "exactly 10", "nine char"]


def some_lines(seed, n):
    pick = random.Random(seed)
    rows = [(i * 7 % n, "\n".join(pick.choices([*LINES, f"only in {i} of them", f"in {i % 9} of nine"], k=pick.randrange(0, 9)))) for i in range(n)]
    return rows + [(3, "another line here\nwith one more line"), (3, None), (None, LINES[0]), (None, "another line here"), (n, None), (-5, "in 4 of nine\n")]


@pytest.mark.parametrize("batches, fanout", [(1, 2), (4, 2), (5, 3)])
def test_lines(spark, batches, fanout):
    rows = some_lines(6, 120)
    docs = spark.createDataFrame(rows, DOCS)
    assert tuples(line_digests(docs, batches, fanout)) == sorted(brute.lines(rows), key=repr)


def test_lines_of_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    want = sorted(brute.lines([r[:2] for r in ROWS]), key=repr)
    assert tuples(line_digests(docs)) == want and tuples(line_digests(wide(docs))) == want
    assert line_digests(docs.limit(0)).collect() == [] and without_repeated_lines(docs.limit(0)).collect() == []
    cut = without_repeated_lines(wide(docs))
    assert cut.columns == wide(docs).columns and cut.count() == len(ROWS)
    assert {r.doc_id: r.text for r in cut.collect() if r.doc_id in (1, 2, 6, 9)} == {1: None, 2: "", 6: "", 9: ROWS[8][1]}


def test_batches_meet_earlier_runs_where_these_lie(spark):
    docs = spark.createDataFrame(some_lines(8, 60), DOCS)
    parts = [fingerprints(docs.filter(f"doc_id % 5 = {i}")) for i in range(5)]
    runs = LineRuns(spark, 4, fanout=2)
    seen = set()
    for part in parts:
        deciding = runs.add(part)
        own = {(r.h1, r.h2) for r in part.collect()}
        earlier = {(r.h1, r.h2) for r in deciding.filter("keeper is null").collect()}
        assert earlier == own & seen
        seen |= own
        held = [r for level in runs.levels for name in level for r in spark.table(name).select("h1", "h2").collect()]
        assert len(held) == len(set(held)) == len(seen)
        assert all(len(level) <= 2 for level in runs.levels)
    assert len(runs.levels) > 1
    # the merge that finds fresh keys moves no run
    run = spark.table(runs.levels[0][-1])
    other = spark.table(runs._stored(fingerprints(docs).select("h1", "h2").distinct()))
    plan = other.join(run.hint("merge"), ["h1", "h2"], "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_rows_that_repeat_a_doc_id_keep_their_places(spark):
    rows = [(1, "first common line\nsecond common line"), (2, "second common line\nown line of two"), (2, "own line of two\nx\nfirst common line")]
    got = {r.text for r in without_repeated_lines(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {rows[0][1], "own line of two", "own line of two\nx"}


def test_no_python_in_line_removal(spark):
    plan = line_digests(spark.read.parquet(f"{FOLDER}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def some_turns(seed, n, kinds, most):
    """Conversations over few different turns, so that they share, extend and repeat one another's prefixes."""
    pick = random.Random(seed)
    rows = []
    for c in range(n):
        length = pick.randrange(1, most)
        rows += [(c, t, pick.choice(["user", "assistant"]) if kinds > 1 else "user", f"said {pick.randrange(kinds)} thing" + " more" * pick.randrange(2)) for t in range(length)]
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("n, kinds, most", [(150, 1, 40), (200, 2, 8), (80, 9, 3), (1, 1, 2)])
def test_trie(spark, n, kinds, most):
    rows = some_turns(n, n, kinds, most)
    assert tuples(trie_nodes(spark.createDataFrame(rows, TURNS))) == sorted(brute.trie(rows), key=repr)


def test_trie_of_odd_rows(spark):
    rows = [
        (0, None, None, None), (0, 1, "user", "hello there"), (0, 2, None, "a b c"), (1, 1, "user", "only one"), (2, 5, "user", ""), (2, 9, None, ""),
        (45, 1, "user", "its base is absent"), (None, 1, "user", "hello"), (None, None, None, None), (-7, 3, "user", "x"), (-40, 3, "user", "y"), (-45, 3, "user", "z z"),
        (7, 1, "user", "w " * 50_000), (8, 1, "a", "bc"), (9, 1, "ab", "c"), (27, 1, "user", "same"), (27, 2, "user", "same"), (3, 1, "user", "hello there"),
    ]
    turns = spark.createDataFrame(rows, TURNS)
    want = sorted(brute.trie(rows), key=repr)
    assert tuples(trie_nodes(turns)) == want and tuples(trie_nodes(wide(turns))) == want
    assert trie_nodes(turns.limit(0)).collect() == [] and trie_nodes(turns.filter("conv_id is null")).collect() == []
    twice = spark.createDataFrame([(60, 1, "user", "same")] * 3 + [(61, 1, "user", "same")] * 2, TURNS)
    assert trie_nodes(twice).agg(F.max("depth"), F.max("n_convs")).first()[1] == 2


def test_trie_of_the_table(spark):
    turns = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    assert tuples(trie_nodes(turns)) == sorted(brute.trie([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]), key=repr)


def test_handles_are_two_fattest(spark):
    rows = spark.createDataFrame([(a, b) for a in range(-1, 40) for b in range(a + 1, 41)], "a long, b long")
    got = rows.select("a", "b", prefix_trie._two_fattest(F.col("a"), F.col("b"))).collect()
    for a, b, f in got:
        assert f == max(range(a + 1, b + 1), key=lambda x: (x & -x) if x else 1 << 60)


def test_a_line_hash_has_two_parts(spark):
    row = fingerprints(spark.createDataFrame([(1, "a line that counts")], DOCS)).first()
    assert row.h1 != row.h2 and line_module.LEAST == 10
