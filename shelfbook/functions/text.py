"""String helpers. All strings are right-trimmed once, at ingestion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def trimmed(df: DataFrame) -> DataFrame:
    """Right-trim every string column, so that later comparisons ignore trailing blanks."""
    return df.select(
        *[
            F.rtrim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def zero_pad(value: Column, width: int) -> Column:
    """Left-fill with zeros; a value that is too long keeps its right end."""
    return F.right(F.concat(F.lit("0" * width), value.cast("string")), F.lit(width))


def alias_key(alias: Column) -> Column:
    """Stock code held in an alias: ten zeros before its last 12 characters, last 20 of that.

    Not a pad to 20: a short alias gives a short key, which matches nothing.
    """
    return F.right(F.concat(F.lit("0" * 10), F.right(alias, F.lit(12))), F.lit(20))


def sku_extension(value: Column) -> Column:
    """Blank or missing extensions become '0'."""
    return F.when(F.trim(value) != "", value).otherwise(F.lit("0"))
