"""Joins of a large table to one with unique keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def lookup_join(rows: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``rows`` to ``lookup`` (one row per key) without a hint and without a job of its own.

    Sizes on disk say little about sizes in memory, so nothing forces a broadcast: Spark takes one by its
    own threshold, or at run time by the size it has measured. Partitions of a frequent key are split at
    run time too (``spark.sql.adaptive.skewJoin``, set in ``session.SETTINGS``).
    """
    return rows.join(lookup, list(on), how)
