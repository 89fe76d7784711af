"""Cut groups give what one window gives, however the rows arrive."""

import pytest
from pyspark.sql import functions as F

from shelfbook.operators.scan import Measure, chunked, find_long_runs, scan, windowed

def measures():
    return [
        Measure("place_of", "count", F.lit(1)),
        Measure("total", "sum", F.col("v")),
        Measure("before", "sum", F.col("v"), "before"),
        Measure("low", "min", F.col("v")),
        Measure("next", "min", F.when(F.col("v") > 5, F.col("p")), "after"),
        Measure("every", "count", F.col("v"), "all"),
        Measure("latest", "last", F.when(F.col("v") > 6, F.struct("p", "v"))),
    ]


def rows(spark):
    """One group holds a third of the rows; arrival order is scrambled."""
    df = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN -1 ELSE id % 40 END AS g", "id AS p",
        "CASE WHEN id % 11 = 0 THEN NULL ELSE xxhash64(id) % 10 END AS v",
    )
    return df.repartition(7, F.xxhash64("p")).sortWithinPartitions(F.xxhash64("v", "p"))


def same(a, b):
    columns = sorted(a.columns)
    pull = lambda df: sorted(map(repr, df.select(*columns).collect()))
    assert pull(a) == pull(b)


@pytest.mark.parametrize("size", [1, 17, 400])
def test_pieces_by_arithmetic(spark, size):
    df, order = rows(spark), [("p", "asc")]
    pieces = df.withColumn("piece", F.floor(F.col("p") / size))
    same(chunked(pieces, ["g"], "piece", order, measures()).drop("piece"), windowed(df, ["g"], order, measures()))


@pytest.mark.parametrize("limit", [30, 200])
def test_pieces_by_range(spark, limit):
    df, order = rows(spark), [("p", "asc")]
    runs = find_long_runs(df, ["g"], limit)
    assert runs.groups >= 1
    same(scan(df, ["g"], order, measures(), runs), windowed(df, ["g"], order, measures()))


def test_descending_order(spark):
    df, order = rows(spark), [("p", "desc")]
    runs = find_long_runs(df, ["g"], 100)
    same(scan(df, ["g"], order, measures()[:-1], runs), windowed(df, ["g"], order, measures()[:-1]))
    with pytest.raises(ValueError):
        scan(df, ["g"], order, measures(), runs)
