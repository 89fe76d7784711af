"""Reading input tables and publishing results as versioned Parquet."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfbook.functions.text import trimmed

Sources = Mapping[str, DataFrame]


def read_sources(spark: SparkSession, folder: str, names) -> dict[str, DataFrame]:
    """Named Parquet tables with right-trimmed strings."""
    return {name: trimmed(spark.read.parquet(f"{folder}/{name}")) for name in names}


def published(folder: str, table: str, version: str) -> str:
    return f"{folder}/{table}/version={version}"


def publish(df: DataFrame, folder: str, table: str, version: str, *cluster_by: str) -> DataFrame:
    """Write one version of a table and read it back.

    A table is never overwritten while a plan reads it; readers move to the new version when it is whole.
    ``cluster_by`` columns are sorted within files, so that their minima and maxima prune well.
    """
    path = published(folder, table, version)
    out = df.sortWithinPartitions(*cluster_by) if cluster_by else df
    out.write.mode("error").parquet(path)
    return df.sparkSession.read.parquet(path)


MANIFEST = "version string, table string"


def complete_versions(spark: SparkSession, folder: str) -> DataFrame:
    """(version, table) of the versions that were written to their end."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def publish_version(tables: Sources, folder: str, version: str) -> dict[str, DataFrame]:
    """Write ``tables`` as one version and read them back. Versions are ordered as text.

    All tables come first; the manifest that names them comes last, as one file, and makes the version visible. A version
    that broke off before that is never read, and can be written again under its name. A complete one can not.
    """
    spark = next(iter(tables.values())).sparkSession
    if not complete_versions(spark, folder).filter(F.col("version") == version).isEmpty():
        raise ValueError(f"version {version!r} is complete already")
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(published(folder, name, version))
    manifest = spark.createDataFrame([(name,) for name in tables], "table string").coalesce(1)
    manifest.write.mode("overwrite").parquet(published(folder, "manifest", version))
    return read_version(spark, folder, version)


def read_version(spark: SparkSession, folder: str, version: str | None = None) -> dict[str, DataFrame]:
    """The tables of a complete version, the last one if none is named."""
    known = complete_versions(spark, folder)
    if version is None:
        version = known.agg(F.max("version")).first()[0]
    names = [row.table for row in known.filter(F.col("version") == version).collect()]  # one row a table
    if not names:
        raise LookupError(f"no complete version {version!r} in {folder}" if version else f"no complete version in {folder}")
    return {name: spark.read.parquet(published(folder, name, version)) for name in names}


