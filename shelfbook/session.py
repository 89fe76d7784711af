"""Session settings and the one place that cuts lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the jobs rely on; all are ordinary SQL options that can be changed per session.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Bytes of a shuffle that one task takes. A line of numbers and padded codes takes some 40 times as much in the sorts and
    # groups of a task as in a compressed shuffle, so that a task of the default 64 MB may need gigabytes.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    # A frequent key is split even where the split costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Rows that lie by run, or by shipment, need no further shuffle to be joined by finer keys.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # A bucket in one file is read in the order in which it was written, and not sorted again.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    # A bucketed table is read by bucket also where it only goes into a union, which then lies as its parts do.
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    # Where no part of one side of a join is larger than a task takes, as measured at run time, that side is hashed and neither is
    # sorted: codes and shipments are padded with zeros, so that a sort compares them whole. A larger part is sorted and may spill.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "8m",
    # Compiled steps longer than the JVM optimises are better run as several short ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


BUCKET_ROWS = 100_000  # rows of a bucketed staging table that one task takes

_own_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names; only a local session without one gets its own."""
    global _own_folder
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _own_folder is None:
        _own_folder = tempfile.mkdtemp(prefix="shelfbook-")
        atexit.register(shutil.rmtree, _own_folder, ignore_errors=True)
    return _own_folder


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` as a staging table in the shared folder and read it back.

    For results that several later steps read, and for values that depend on how a shuffle happened to
    split its rows: a lost executor must not make Spark evaluate those a second time.
    """
    path = f"{shared_folder(df.sparkSession)}/staging-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def buckets_for(spark: SparkSession, rows: int) -> int:
    """Buckets for a staging table of so many rows; they grow with it, so that the rows of a task do not."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // BUCKET_ROWS))


def durable_by(df: DataFrame, keys: Sequence[str], buckets: int, sort: Sequence[str] = ()) -> DataFrame:
    """As ``durable``, in ``buckets`` buckets of equal ``keys``: windows, groups and joins that have the keys among theirs do not
    shuffle the table again.

    Rows that are dealt by the same keys over the same number already are written as they lie. All rows of one key lie in one
    bucket, so keys of unbounded groups belong to ``durable``.
    """
    spark, name = df.sparkSession, f"staging_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys, *sort)
    writer.option("path", f"{shared_folder(spark)}/{name}").saveAsTable(name)
    return spark.table(name)
